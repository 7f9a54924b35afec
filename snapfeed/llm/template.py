"""A sandboxed template language, compiled to Python closures.

``{{ expression }}`` prints, ``{% for x in xs %} … {% endfor %}`` repeats,
``{% if a %} … {% elif b %} … {% else %} … {% endif %}`` chooses, and
``{% generation %} … {% endgeneration %}`` marks what a model is to produce.
Expressions have strings, numbers, ``true``, ``false``, ``none``, names,
``a.b``, ``a['b']``, ``+``, comparisons, ``and``, ``or``, ``not``,
``a if b else c`` and filters ``a|escape``. There are no calls and no access to
attributes of Python objects: ``a.b`` looks up a key of a dictionary.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

Piece = tuple[str, bool]  # text, and whether a model is to produce it


class TemplateError(ValueError):
    """The template is not of this language."""


@dataclass
class Text:
    value: str


@dataclass
class Output:
    value: ast.expr


@dataclass
class For:
    name: str
    items: ast.expr
    body: list = field(default_factory=list)


@dataclass
class If:
    test: ast.expr
    body: list = field(default_factory=list)
    other: list = field(default_factory=list)


@dataclass
class Generation:
    body: list = field(default_factory=list)


_TAGS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_CONSTANTS = {"true": True, "false": False, "none": None}
_COMPARE: dict[type, Callable] = {
    ast.Eq: lambda a, b: a == b,
    ast.NotEq: lambda a, b: a != b,
    ast.Lt: lambda a, b: a < b,
    ast.Gt: lambda a, b: a > b,
    ast.LtE: lambda a, b: a <= b,
    ast.GtE: lambda a, b: a >= b,
    ast.In: lambda a, b: a in b,
    ast.NotIn: lambda a, b: a not in b,
}


def expression(source: str) -> ast.expr:
    try:
        return ast.parse(source.strip(), mode="eval").body
    except (SyntaxError, ValueError) as error:
        raise TemplateError(f"no expression: {source.strip()!r}") from error


def parse(source: str) -> list:
    """The syntax tree of a template."""
    root: list = []
    open_tags: list[tuple[str, object]] = []
    into = root
    stack = [root]
    at = 0
    for tag in _TAGS.finditer(source):
        if tag.start() > at:
            into.append(Text(source[at : tag.start()]))
        at = tag.end()
        if tag[1] is not None:
            into.append(Output(expression(tag[1])))
            continue
        word, _, rest = tag[2].strip().partition(" ")
        kind = open_tags[-1][0] if open_tags else ""
        if word == "for" and (m := re.fullmatch(r"\s*(\w+)\s+in\s+(.+)", rest, re.S)):
            node: object = For(m[1], expression(m[2]))
        elif word == "if":
            node = If(expression(rest))
        elif word == "generation":
            node = Generation()
        elif word == "elif" and kind == "if":
            inner = If(expression(rest))
            open_tags[-1][1].other.append(inner)  # type: ignore[attr-defined]
            open_tags[-1] = ("if", inner)
            into = stack[-1] = inner.body
            continue
        elif word == "else" and kind == "if":
            into = stack[-1] = open_tags[-1][1].other  # type: ignore[attr-defined]
            open_tags[-1] = ("else", open_tags[-1][1])
            continue
        elif word in ("endfor", "endif", "endgeneration") and kind in {
            "endfor": ("for",), "endif": ("if", "else"), "endgeneration": ("generation",)
        }[word]:
            open_tags.pop()
            stack.pop()
            into = stack[-1]
            continue
        else:
            raise TemplateError(f"unexpected tag: {tag[0]!r}")
        into.append(node)
        open_tags.append((word, node))
        into = node.body  # type: ignore[attr-defined]
        stack.append(into)
    if open_tags:
        raise TemplateError(f"{open_tags[-1][0]} is not closed")
    if at < len(source):
        into.append(Text(source[at:]))
    return root


@dataclass
class _Value:
    """A compiled expression; ``constant`` if no name has a part in it."""

    get: Callable[[dict], object]
    constant: bool = False


def _known(value: object) -> _Value:
    return _Value(lambda scope: value, True)


def _folded(parts: list[_Value], get: Callable[[dict], object]) -> _Value:
    return _known(get({})) if all(part.constant for part in parts) else _Value(get)


class Compiler:
    def __init__(self, filters: dict[str, Callable[[object], object]]):
        self.filters = filters

    def value(self, e: ast.expr) -> _Value:
        if isinstance(e, ast.Constant) and isinstance(e.value, str | int | float):
            return _known(e.value)
        if isinstance(e, ast.Name):
            if e.id in _CONSTANTS:
                return _known(_CONSTANTS[e.id])
            name = e.id
            return _Value(lambda scope: scope.get(name))
        if isinstance(e, ast.Attribute | ast.Subscript):
            inner = self.value(e.value)
            key = _known(e.attr) if isinstance(e, ast.Attribute) else self.value(e.slice)

            def look(scope, of=inner.get, key=key.get):
                found = of(scope)
                return found.get(key(scope)) if isinstance(found, dict) else None

            return _folded([inner, key], look)
        if isinstance(e, ast.BinOp) and isinstance(e.op, ast.BitOr) and isinstance(e.right, ast.Name):
            if e.right.id not in self.filters:
                raise TemplateError(f"no such filter: {e.right.id}")
            inner, change = self.value(e.left), self.filters[e.right.id]
            return _folded([inner], lambda scope, of=inner.get: change(of(scope)))
        if isinstance(e, ast.BinOp) and isinstance(e.op, ast.Add):
            a, b = self.value(e.left), self.value(e.right)

            def add(scope, a=a.get, b=b.get):
                x, y = a(scope), b(scope)
                return _shown(x) + _shown(y) if isinstance(x, str) or isinstance(y, str) else x + y

            return _folded([a, b], add)
        if isinstance(e, ast.BoolOp):
            parts = [self.value(x) for x in e.values]
            joined = all if isinstance(e.op, ast.And) else any
            return _folded(parts, lambda scope: joined(p.get(scope) for p in parts))
        if isinstance(e, ast.UnaryOp) and isinstance(e.op, ast.Not):
            inner = self.value(e.operand)
            return _folded([inner], lambda scope: not inner.get(scope))
        if isinstance(e, ast.IfExp):
            test, a, b = self.value(e.test), self.value(e.body), self.value(e.orelse)
            return _folded([test, a, b], lambda scope: (a if test.get(scope) else b).get(scope))
        if isinstance(e, ast.Compare) and len(e.ops) == 1 and type(e.ops[0]) in _COMPARE:
            a, b = self.value(e.left), self.value(e.comparators[0])
            same = _COMPARE[type(e.ops[0])]
            return _folded([a, b], lambda scope: same(a.get(scope), b.get(scope)))
        raise TemplateError(f"not allowed: {ast.unparse(e)}")

    def fold(self, nodes: list) -> list:
        """Prints of constants become text, choices on constants are made, texts are joined."""
        out: list = []
        for node in nodes:
            if isinstance(node, Output) and (v := self.value(node.value)).constant:
                node = Text(_shown(v.get({})))
            if isinstance(node, If) and (v := self.value(node.test)).constant:
                new = self.fold(node.body if v.get({}) else node.other)
            elif isinstance(node, If):
                new = [If(node.test, self.fold(node.body), self.fold(node.other))]
            elif isinstance(node, For):
                new = [For(node.name, node.items, self.fold(node.body))]
            elif isinstance(node, Generation):
                new = [Generation(self.fold(node.body))]
            else:
                new = [node]
            for x in new:
                if isinstance(x, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + x.value)
                else:
                    out.append(x)
        return out

    def block(self, nodes: list) -> Callable[[dict, bool], Iterator[Piece]]:
        parts = [self.closure(node) for node in nodes]

        def run(scope: dict, marked: bool) -> Iterator[Piece]:
            for part in parts:
                yield from part(scope, marked)

        return run

    def closure(self, node) -> Callable[[dict, bool], Iterator[Piece]]:
        if isinstance(node, Text):
            return lambda scope, marked, text=node.value: iter(((text, marked),))
        if isinstance(node, Output):
            get = self.value(node.value).get
            return lambda scope, marked: iter(((_shown(get(scope)), marked),))
        if isinstance(node, Generation):
            inner = self.block(node.body)
            return lambda scope, marked: inner(scope, True)
        if isinstance(node, If):
            test, yes, no = self.value(node.test).get, self.block(node.body), self.block(node.other)
            return lambda scope, marked: (yes if test(scope) else no)(scope, marked)
        items, body, name = self.value(node.items).get, self.block(node.body), node.name

        def repeat(scope: dict, marked: bool) -> Iterator[Piece]:
            rest = iter(items(scope) or ())
            index, item = 0, next(rest, None)
            while item is not None:
                after = next(rest, None)
                loop = {"index0": index, "index": index + 1, "first": not index, "last": after is None}
                yield from body({**scope, name: item, "loop": loop}, marked)
                index, item = index + 1, after

        return repeat


def _shown(value: object) -> str:
    return "" if value is None else str(value)


def compile_template(
    source: str, filters: dict[str, Callable[[object], object]] | None = None
) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages to pieces of text with their generation mark.

    The messages may be any iterable; a conversation is rendered as it is read.
    """
    compiler = Compiler(filters or {})
    run = compiler.block(compiler.fold(parse(source)))
    return lambda messages, **names: run({**names, "messages": messages}, False)
