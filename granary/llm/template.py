"""A small sandboxed template language for conversations, compiled to closures.

    {{ turn.text | guard }}                      output of an expression
    {% for turn in turns %} ... {% endfor %}     loop.first, loop.last, loop.index0
    {% if a == 'b' %} ... {% elif %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}     what the loss mask covers

Expressions have strings, whole numbers, true, false, none, names, fields of
turns and of ``loop``, ``+``, comparisons, ``in``, ``and``, ``or``, ``not``,
parentheses and the filters given to ``compile_template``. A template reaches
nothing else: a field is looked up in a mapping, never as a Python attribute.

Source becomes a syntax tree, constant parts of the tree are folded, and every
node becomes one Python closure. Rendering is a generator, so a ``for`` over an
iterator of turns holds one turn (and the next, for ``loop.last``) at a time.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

Piece = tuple[str, bool, bool]  # text, generated, whether a loop's round ends here
Scope = dict[str, Any]

TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
TOKEN = re.compile(r"""\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+|().]))""")
COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
CONSTANTS = {"true": True, "false": False, "none": None}
ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template is not well formed or asks for something it may not reach."""


# -- parsing: text to a tree of tuples (kind, ...) --


class _Expression:
    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            number, single, double, name, sign = m.groups()
            if number:
                self.tokens.append(("value", int(number)))
            elif name:
                self.tokens.append(("name", name))
            elif sign:
                self.tokens.append(("sign", sign))
            else:
                quoted = single if single is not None else double
                self.tokens.append(("value", re.sub(r"\\(.)", lambda e: ESCAPES.get(e[1], e[1]), quoted, flags=re.DOTALL)))
            at = m.end()
        self.at = 0

    def peek(self, *wanted: str) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)
        return value if kind in ("name", "sign") and value in wanted else None

    def take(self, *wanted: str) -> str | None:
        found = self.peek(*wanted)
        self.at += found is not None
        return found

    def name(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)
        if kind != "name" or value.startswith("_"):
            raise TemplateError("a name is missing or not allowed")
        self.at += 1
        return value

    def whole(self) -> tuple:
        tree = self.disjunction()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def disjunction(self) -> tuple:
        tree = self.conjunction()
        while self.take("or"):
            tree = ("or", tree, self.conjunction())
        return tree

    def conjunction(self) -> tuple:
        tree = self.negation()
        while self.take("and"):
            tree = ("and", tree, self.negation())
        return tree

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("not") else self.comparison()

    def comparison(self) -> tuple:
        tree = self.sum()
        if sign := self.take(*COMPARE):
            return ("compare", sign, tree, self.sum())
        if self.take("in"):
            return ("in", tree, self.sum())
        return tree

    def sum(self) -> tuple:
        tree = self.filtered()
        while self.take("+"):
            tree = ("add", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.primary()
        while sign := self.take(".", "|"):
            tree = ("field" if sign == "." else "filter", tree, self.name())
        return tree

    def primary(self) -> tuple:
        if self.take("("):
            tree = self.disjunction()
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return tree
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)
        if kind == "value":
            self.at += 1
            return ("value", value)
        name = self.name()
        return ("value", CONSTANTS[name]) if name in CONSTANTS else ("get", name)


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts, at = [], 0
    for m in TAG.finditer(source):
        parts += [("text", source[at : m.start()])] if m.start() > at else []
        parts.append(("show", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts += [("text", source[at:])] if at < len(source) else []
    tree, place, end = _block(parts, 0)
    if end:
        raise TemplateError(f"{end!r} without a beginning")
    return tree


def _block(parts: list[tuple], at: int) -> tuple[tuple, int, str]:
    body: list[tuple] = []
    while at < len(parts):
        kind, source = parts[at]
        at += 1
        if kind == "text":
            body.append(("text", source))
        elif kind == "show":
            body.append(("show", _Expression(source).whole()))
        elif m := re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.+)", source, re.DOTALL):
            inner, at, end = _block(parts, at)
            _expect(end, "endfor")
            body.append(("for", m[1], _Expression(m[2]).whole(), inner))
        elif source == "generation":
            inner, at, end = _block(parts, at)
            _expect(end, "endgeneration")
            body.append(("generation", inner))
        elif m := re.fullmatch(r"if\s+(.+)", source, re.DOTALL):
            tree, at = _choice(m[1], parts, at)
            body.append(tree)
        else:
            return ("block", tuple(body)), at, source
    return ("block", tuple(body)), at, ""


def _choice(condition: str, parts: list[tuple], at: int) -> tuple[tuple, int]:
    then, at, end = _block(parts, at)
    other: tuple = ("block", ())
    if m := re.fullmatch(r"elif\s+(.+)", end, re.DOTALL):
        other, at = _choice(m[1], parts, at)
    elif end == "else":
        other, at, end = _block(parts, at)
        _expect(end, "endif")
    else:
        _expect(end, "endif")
    return ("if", _Expression(condition).whole(), then, other), at


def _expect(found: str, wanted: str) -> None:
    if found != wanted:
        raise TemplateError(f"{wanted!r} expected, {found or 'the end'!r} found")


# -- folding --


def fold(tree: tuple, filters: dict[str, Callable]) -> tuple:
    """The tree with its constant parts computed."""
    kind = tree[0]
    if kind in ("text", "value", "get"):
        return tree
    if kind == "block":
        parts: list[tuple] = []
        for part in (fold(p, filters) for p in tree[1]):
            inner = part[1] if part[0] == "block" else (part,)
            for p in inner:
                if p[0] == "text" and parts and parts[-1][0] == "text":
                    parts[-1] = ("text", parts[-1][1] + p[1])
                elif p != ("text", ""):
                    parts.append(p)
        return ("block", tuple(parts))
    tree = tuple(fold(x, filters) if isinstance(x, tuple) else x for x in tree)
    if kind == "if":
        return (tree[2] if tree[1][1] else tree[3]) if tree[1][0] == "value" else tree
    if kind == "show":
        return ("text", _shown(tree[1][1])) if tree[1][0] == "value" else tree
    operands = [x for x in tree[1:] if isinstance(x, tuple)]
    if kind not in ("for", "generation") and all(x[0] == "value" for x in operands):
        return ("value", _value(tree, filters)({}))
    return tree


# -- closures --


def _shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _field(value: Any, name: str) -> Any:
    if not isinstance(value, dict) or name not in value:
        raise TemplateError(f"no field {name!r}")
    return value[name]


def _value(tree: tuple, filters: dict[str, Callable]) -> Callable[[Scope], Any]:
    kind = tree[0]
    if kind == "value":
        return lambda scope, value=tree[1]: value
    if kind == "get":
        return lambda scope, name=tree[1]: _field(scope, name)
    inside = [_value(x, filters) for x in tree[1:] if isinstance(x, tuple)]
    first, second = inside[0], inside[-1]
    if kind == "field":
        return lambda scope, name=tree[2]: _field(first(scope), name)
    if kind == "filter":
        if tree[2] not in filters:
            raise TemplateError(f"no filter {tree[2]!r}")
        return lambda scope, apply=filters[tree[2]]: apply(first(scope))
    if kind == "not":
        return lambda scope: not first(scope)
    if kind == "and":
        return lambda scope: first(scope) and second(scope)
    if kind == "or":
        return lambda scope: first(scope) or second(scope)
    if kind == "in":
        return lambda scope: first(scope) in second(scope)
    if kind == "add":
        return lambda scope: first(scope) + second(scope)
    return lambda scope, compare=COMPARE[tree[1]]: compare(first(scope), second(scope))


def _writer(tree: tuple, filters: dict[str, Callable], generated: bool) -> Callable[[Scope], Iterator[Piece]]:
    kind = tree[0]
    if kind == "text":
        return lambda scope, piece=(tree[1], generated, False): iter((piece,))
    if kind == "show":
        value = _value(tree[1], filters)
        return lambda scope: iter(((_shown(value(scope)), generated, False),))
    if kind == "generation":
        return _writer(tree[1], filters, True)
    if kind == "block":
        parts = [_writer(part, filters, generated) for part in tree[1]]

        def write_all(scope: Scope) -> Iterator[Piece]:
            for part in parts:
                yield from part(scope)

        return write_all
    if kind == "if":
        test, then, other = _value(tree[1], filters), *(_writer(x, filters, generated) for x in tree[2:])
        return lambda scope: then(scope) if test(scope) else other(scope)
    name, source, body = tree[1], _value(tree[2], filters), _writer(tree[3], filters, generated)

    def rounds(scope: Scope) -> Iterator[Piece]:
        items, index = iter(source(scope)), 0
        item = next(items, items)
        while item is not items:
            following = next(items, items)
            loop = {"index0": index, "first": index == 0, "last": following is items}
            yield from body(scope | {name: item, "loop": loop})
            yield "", generated, True
            item, index = following, index + 1

    return rounds


def compile_template(source: str, filters: dict[str, Callable[[Any], Any]]) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A renderer: from turns (dicts) to pieces of text, each marked as generated or not."""
    write = _writer(fold(parse(source), filters), filters, False)
    return lambda turns: write({"turns": turns})
