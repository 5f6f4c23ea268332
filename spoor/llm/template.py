"""A small sandboxed template language, compiled to Python closures.

    text {{ expression }} {% for x in expression %} ... {% endfor %}
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}  {% generation %} ... {% endgeneration %}

Expressions: string and integer literals, names, ``a.b`` (a key of a mapping, never an attribute), ``a + b``, ``==``,
``!=``, ``not``, ``and``, ``or``, parentheses, and ``a | filter`` with a filter that the caller gives. There are no calls
and no attributes, so a template reaches nothing but the values it is given.

``parse`` gives the syntax tree, ``fold`` computes what is constant, ``compile_template`` makes closures. Rendering
returns the text and the spans of it that stand in generation blocks.
"""

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[+|.()]))""")
ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template is not of this language."""


class _Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, text: str):
        self.items, at = [], 0
        text = text.rstrip()
        while at < len(text):
            m = TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"can't read {text[at:]!r}")
            self.items.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.items[self.at][1] if self.at < len(self.items) and self.items[self.at][0] in ("op", "name") else None

    def take(self, *wanted: str) -> str | None:
        if (now := self.peek()) in wanted:
            self.at += 1
            return now
        return None

    def whole(self) -> tuple:
        node = self.either()
        if self.at != len(self.items):
            raise TemplateError(f"unexpected {self.items[self.at][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.added()
        if op := self.take("==", "!="):
            node = (op, node, self.added())
        return node

    def added(self) -> tuple:
        node = self.filtered()
        while self.take("+"):
            node = ("+", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.atom()
        while op := self.take("|", "."):
            if self.at >= len(self.items) or self.items[self.at][0] != "name":
                raise TemplateError(f"a name must follow {op!r}")
            node = ("filter" if op == "|" else "key", node, self.items[self.at][1])
            self.at += 1
        return node

    def atom(self) -> tuple:
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("a parenthesis stays open")
            return node
        if self.at >= len(self.items):
            raise TemplateError("an expression ends early")
        kind, text = self.items[self.at]
        self.at += 1
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "int":
            return ("const", int(text))
        if kind == "name":
            return ("name", text)
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> tuple:
    """The syntax tree: ("block", [node, ...]) of text, out, for, if and generation nodes."""
    stack: list[tuple[str, Any, list]] = [("", None, [])]
    at = 0
    for m in TAG.finditer(source):
        if m.start() > at:
            stack[-1][2].append(("text", source[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            stack[-1][2].append(("out", _Expression(m[1]).whole()))
            continue
        word, _, rest = m[2].strip().partition(" ")
        if word == "for" and (x := re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)):
            stack.append(("for", (x[1], _Expression(x[2]).whole()), []))
        elif word == "if":
            stack.append(("if", [(_Expression(rest).whole(), [])], []))
            stack[-1] = ("if", stack[-1][1], stack[-1][1][0][1])
        elif word in ("elif", "else") and stack[-1][0] == "if":
            arms = stack[-1][1]
            arms.append((_Expression(rest).whole() if word == "elif" else ("const", True), []))
            stack[-1] = ("if", arms, arms[-1][1])
        elif word == "generation":
            stack.append(("generation", None, []))
        elif word in ("endfor", "endif", "endgeneration") and stack[-1][0] == word[3:]:
            kind, head, body = stack.pop()
            stack[-1][2].append({"for": lambda: ("for", *head, ("block", body)), "if": lambda: ("if", [(c, ("block", b)) for c, b in head]), "generation": lambda: ("generation", ("block", body))}[kind]())
        else:
            raise TemplateError(f"unexpected {m[2].strip()!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not ended")
    if at < len(source):
        stack[0][2].append(("text", source[at:]))
    return ("block", stack[0][2])


def fold(node: tuple, filters: Mapping[str, Callable[[str], str]]) -> tuple:
    """The same tree with constant expressions computed, dead arms gone and neighbouring texts joined."""
    kind = node[0]
    if kind == "block":
        out: list[tuple] = []
        for x in (fold(y, filters) for y in node[1]):
            for z in x[1] if x[0] == "block" else [x]:
                if z[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + z[1])
                elif z != ("text", ""):
                    out.append(z)
        return ("block", out)
    if kind == "out":
        x = fold(node[1], filters)
        return ("text", _text(x[1])) if x[0] == "const" else ("out", x)
    if kind == "for":
        return ("for", node[1], fold(node[2], filters), fold(node[3], filters))
    if kind == "generation":
        return ("generation", fold(node[1], filters))
    if kind == "if":
        arms = []
        for condition, body in node[1]:
            condition = fold(condition, filters)
            if condition[0] == "const" and not condition[1]:
                continue
            arms.append((condition, fold(body, filters)))
            if condition[0] == "const":
                break
        return arms[0][1] if arms and arms[0][0][0] == "const" else ("if", arms) if arms else ("block", [])
    if kind in ("const", "name", "text"):
        return node
    if kind in ("key", "filter"):
        x = fold(node[1], filters)
        if kind == "filter" and node[2] not in filters:
            raise TemplateError(f"no filter {node[2]!r}")
        return ("const", filters[node[2]](_text(x[1]))) if kind == "filter" and x[0] == "const" else (kind, x, node[2])
    parts = [fold(x, filters) for x in node[1:]]
    new = (kind, *parts)
    return ("const", _value(new, filters)({})) if all(p[0] == "const" for p in parts) else new


def _text(value: Any) -> str:
    return "" if value is None else str(value)


def _value(node: tuple, filters: Mapping[str, Callable[[str], str]]) -> Callable[[dict], Any]:
    """A closure from a scope to the expression's value; an unknown name or key is None."""
    kind = node[0]
    if kind == "const":
        return lambda scope, x=node[1]: x
    if kind == "name":
        return lambda scope, x=node[1]: scope.get(x)
    first = _value(node[1], filters)
    if kind == "key":
        return lambda scope, x=node[2]: v.get(x) if isinstance(v := first(scope), Mapping) else None
    if kind == "filter":
        return lambda scope, f=filters[node[2]]: f(_text(first(scope)))
    if kind == "not":
        return lambda scope: not first(scope)
    second = _value(node[2], filters)
    return {
        "and": lambda scope: first(scope) and second(scope),
        "or": lambda scope: first(scope) or second(scope),
        "==": lambda scope: first(scope) == second(scope),
        "!=": lambda scope: first(scope) != second(scope),
        "+": lambda scope: _text(first(scope)) + _text(second(scope)),
    }[kind]


class _Output:
    """What has been rendered since it was last taken, and how much there was in all."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = self.taken = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)

    def take(self) -> tuple[int, str, list[tuple[int, int]]]:
        """(start, text, spans) of what is new."""
        new = self.taken, "".join(self.parts), self.spans
        self.parts, self.spans, self.taken = [], [], self.length
        return new


def _leaf(node: tuple, filters: Mapping[str, Callable[[str], str]]) -> Callable[[dict, _Output], None] | None:
    """What a node that holds no others does; None of any other."""
    if node[0] == "text":
        return lambda scope, out, x=node[1]: out.add(x)
    if node[0] == "out":
        value = _value(node[1], filters)
        return lambda scope, out: out.add(_text(value(scope)))
    return None


def _action(node: tuple, filters: Mapping[str, Callable[[str], str]]) -> Callable[[dict, _Output], Iterator[None]]:
    """A closure that renders a node and rests after each turn of a loop, so that what there is can be taken."""
    kind = node[0]
    if (leaf := _leaf(node, filters)) is not None:

        def once(scope: dict, out: _Output) -> Iterator[None]:
            leaf(scope, out)
            return iter(())

        return once
    if kind == "block":
        steps = [(leaf, None) if (leaf := _leaf(x, filters)) is not None else (None, _action(x, filters)) for x in node[1]]

        def block(scope: dict, out: _Output) -> Iterator[None]:
            for leaf, step in steps:
                if leaf is not None:
                    leaf(scope, out)
                else:
                    yield from step(scope, out)

        return block
    if kind == "for":
        name, items, body = node[1], _value(node[2], filters), _action(node[3], filters)

        def loop(scope: dict, out: _Output) -> Iterator[None]:
            for x in items(scope) or ():
                yield from body({**scope, name: x}, out)
                yield

        return loop
    if kind == "if":
        arms = [(_value(c, filters), _action(b, filters)) for c, b in node[1]]

        def choose(scope: dict, out: _Output) -> Iterator[None]:
            for condition, body in arms:
                if condition(scope):
                    yield from body(scope, out)
                    return

        return choose
    body = _action(node[1], filters)

    def generation(scope: dict, out: _Output) -> Iterator[None]:
        began = out.length
        for _ in body(scope, out):
            pass  # a marked stretch is never parted
        out.spans.append((began, out.length))
        return iter(())

    return generation


def _uses(node: Any, name: str) -> int:
    """How often an expression of the tree asks for a name."""
    if isinstance(node, tuple) and node[:1] == ("name",):
        return int(node[1] == name)
    return sum(_uses(x, name) for x in node) if isinstance(node, (tuple, list)) else 0


def compile_template(source: str, filters: Mapping[str, Callable[[str], str]] | None = None) -> Callable[..., tuple[str, list[tuple[int, int]]]]:
    """A function of the template's names that gives the text and its generation spans, in code points, ends excluded."""
    run = _action(fold(parse(source), filters or {}), filters or {})

    def render(**names: Any) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        for _ in run(names, out):
            pass
        return out.take()[1:]

    return render


def compile_stream(source: str, name: str, filters: Mapping[str, Callable[[str], str]] | None = None) -> Callable[[Iterable, int], Iterator[tuple[int, str, list[tuple[int, int]]]]]:
    """A function of the items of one name that gives (start, text, spans) piece by piece, as soon as a piece has so many characters.

    Items may come from an iterator; a template that asks for the name more than once gets them as a list.
    """
    tree = fold(parse(source), filters or {})
    run, again = _action(tree, filters or {}), _uses(tree, name) > 1

    def stream(items: Iterable, piece: int) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
        out = _Output()
        for _ in run({name: list(items) if again else items}, out):
            if out.length - out.taken >= piece:
                yield out.take()
        if out.length > out.taken or not out.length:
            yield out.take()

    return stream
