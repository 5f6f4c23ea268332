"""URL filter: a weighted vocabulary counted by an Aho-Corasick automaton, beneath host and path rules.

Terms weigh points. A strict term has the points that reject a url by itself; soft ones reject when several distinct ones occur
and their points add up. A hit counts if neither neighbour in the url is a letter or digit, of any script. A rule that fits
the url outranks the vocabulary, the longest rule first.
"""

from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points that reject, and the fewest distinct soft terms that may reach them.
LIMIT, SOFT_HITS = 100, 2
#: General terms by points: strict ones, soft ones of which two reject, and weak ones of which it takes four.
_STRICT = """
adult bdsm bondage bukkake camgirl camgirls camsex cialis casino casinos creampie cuckold darknet escort escorts fetish gangbang hardcore hentai hookers
keygen keygens levitra malware milf milfs nsfw nudist onlyfans phishing porn porno pornos porntube ransomware redtube rule34 sexcam sexcams sexshop spam spyware
strippers tramadol upskirt viagra warez webcamsex xanax xhamster xnxx xvideos xxx youporn
"""
_SOFT = """
bet bets betting bingo bookmaker cam cams cheap crack cracked cracks dating erotic erotik erotique escorte free gambling glücksspiel gratis hack hacked
jackpot lingerie loan loans lottery lotto naked nude nudes nulled payday pharma pharmacy pills poker pokies rencontres replica roulette serial serials sex sexe sexo sexy
slot slots steroids torrent torrents voyeur wager win
"""
_WEAK = "ads affiliate banner bonus buy click clickbait coupon deal deals discount doorway offer offers popup prize promo referral sale sponsored track tracker tracking traffic"
VOCABULARY = {t: points for terms, points in ((_WEAK, 25), (_SOFT, 50), (_STRICT, LIMIT)) for t in terms.split()}
#: The rules of the query, as (action, host and path).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))


def read_vocabulary(path: str) -> dict[str, int]:
    """Terms and points of a file of tab-separated lines, lower-cased; a line without points is a strict term."""
    lines = [x.rstrip("\n").split("\t") for x in open(path, encoding="utf-8") if x.strip() and not x.startswith("#")]
    return {x[0].lower(): int(x[1]) if len(x) > 1 else LIMIT for x in lines}


@cache
def automaton(vocabulary: tuple[tuple[str, int], ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, points in vocabulary:
        found.add_word(term, (term, points))
    found.make_automaton()
    return found


def _inside(url: str, at: int) -> bool:
    return 0 <= at < len(url) and url[at].isalnum()


def term_counts(url: str | None, vocabulary: tuple[tuple[str, int], ...] = tuple(VOCABULARY.items())) -> tuple[int, int, int]:
    """Strict hits, distinct soft terms hit and their points, in the url with A-Z lower-cased."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    hits, soft = 0, {}
    if vocabulary and low:
        for end, (term, points) in automaton(vocabulary).iter(low):
            if _inside(low, end + 1) or _inside(low, end - len(term)):
                continue
            if points >= LIMIT:
                hits += 1
            else:
                soft[term] = points
    return hits, len(soft), sum(soft.values())


def with_term_counts(pages: DataFrame, url_col: str = "url", vocabulary: dict[str, int] = VOCABULARY) -> DataFrame:
    """``pages`` plus strict_hits, soft_terms and soft_points; a null url has none of them."""
    terms, names = tuple(vocabulary.items()), ["strict_hits", "soft_terms", "soft_points"]

    @F.pandas_udf(f"struct<{', '.join(f'{c}:long' for c in names)}>")
    def run(urls):
        return pd.DataFrame([term_counts(u, terms) for u in urls], columns=names)

    return pages.withColumn("_terms", run(F.col(url_col).cast("string"))).withColumns({c: F.col(f"_terms.{c}") for c in names}).drop("_terms")


def _after_scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next slash, question mark or hash, A-Z lower-cased; else empty."""
    upper = "".join(map(chr, range(65, 91)))
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash; empty without one."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, action) of the longest rule whose host is the url's or a parent of it and whose path begins the url's."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        text, action = F.when(fits, rule).otherwise(text), F.when(fits, act).otherwise(action)
    return text, action


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, id_col: str = "page_id", url_col: str = "url", vocabulary: dict[str, int] = VOCABULARY, soft_hits: int = SOFT_HITS) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_terms and soft_points of every row.

    A null or scheme-less url has an empty host and path, so that no rule fits it; its vocabulary is counted all the
    same, and null allows. Repeated rows come back as often; other columns are not read; an empty table gives none.
    """
    found = with_term_counts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")), "url", vocabulary)
    found = found.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, action = ruled(F.col("host"), F.col("path"), rules)
    rejected = (F.col("strict_hits") > 0) | ((F.col("soft_terms") >= soft_hits) & (F.col("soft_points") >= LIMIT))
    verdict = F.coalesce(action, F.when(rejected, "block").otherwise("allow"))
    return found.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "strict_hits", "soft_terms", "soft_points")


def oracle(rules: tuple[tuple[str, str], ...] = RULES, vocabulary: dict[str, int] = VOCABULARY, soft_hits: int = SOFT_HITS) -> str:
    """DuckDB SQL of :func:`judge`."""
    edge = "[^\\p{L}\\p{N}]"
    listed = lambda few: "|".join(sorted(few, key=lambda t: (-len(t), t)))
    strict, soft = [t for t, p in vocabulary.items() if p >= LIMIT], {t: p for t, p in vocabulary.items() if p < LIMIT}
    # RE2 cannot look around: doubling every character that is no letter or digit keeps neighbours apart, as terms have none.
    hits = lambda few: f"regexp_extract_all(wide, '(?:^|{edge})({listed(few)})(?:$|{edge})', 1)"
    points = "CASE x " + " ".join(f"WHEN '{t}' THEN {p}" for t, p in soft.items()) + " END"
    fits = lambda r: f"(host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}')"
    ladder = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for _, r in ladder) + " END"
    action = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{a}'" for a, r in ladder) + " END"
    return f"""
WITH a AS (SELECT page_id, coalesce(url, '') AS url, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
b AS (SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
  translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, regexp_replace(low, '({edge})', '\\1\\1', 'g') AS wide FROM b),
d AS (SELECT *, CAST(len({hits(strict)}) AS BIGINT) AS strict_hits, list_distinct({hits(soft)}) AS soft FROM c),
e AS (SELECT *, CAST(len(soft) AS BIGINT) AS soft_terms, CAST(coalesce(list_sum(list_transform(soft, lambda x: {points})), 0) AS BIGINT) AS soft_points FROM d)
SELECT page_id, host, path, {rule} AS rule,
  coalesce({action}, CASE WHEN strict_hits > 0 OR (soft_terms >= {soft_hits} AND soft_points >= {LIMIT}) THEN 'block' ELSE 'allow' END) AS verdict, strict_hits, soft_terms, soft_points FROM e"""
