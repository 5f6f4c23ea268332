"""Queries over the test tables, one or more for each operator, with the DuckDB SQL that gives the same rows."""

from spoor.plans import amended, derivation, evidence, graph, highlighted, prose, relational, reported, reuse, routed, sheets, streams, tabled, temporal, texts

MODULES = (amended, reported, reuse, temporal, graph, relational, texts, prose, sheets, streams, evidence, derivation, routed, tabled, highlighted)
