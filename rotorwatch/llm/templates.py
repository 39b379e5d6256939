"""A small sandboxed template language for chats: parse to a syntax tree, fold constants, compile to closures.

``{{ expression }}``, ``{% for x in e %} ... {% endfor %}``, ``{% if e %} ... {% elif e %} ... {% else %} ... {% endif %}``,
``{% generation %} ... {% endgeneration %}`` (what a model is trained to write) and ``{# comments #}``.  Expressions:
strings, integers, true, false, none, names, ``a.b`` and ``a['b']``, ``|filter``, ``+``, ``==``, ``!=``, ``not``, ``and``,
``or``, parentheses.  Values are strings, integers, booleans, none, and mappings and streams of them; member access reads
mappings only, there are no calls, and filters are those handed to :func:`compile_template`: a template reaches nothing else.

A compiled template is a generator of strings and of ``OPEN`` / ``CLOSE`` marks around generations, so a conversation of
any length is rendered as it is read.  ``messages`` may be a stream: it can be walked once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace
from typing import Any

OPEN, CLOSE = object(), object()


class TemplateError(ValueError):
    pass


# syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Member:
    of: Any
    key: Any


@dataclass(frozen=True)
class Filter:
    of: Any
    name: str


@dataclass(frozen=True)
class Binary:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Not:
    of: Any


@dataclass(frozen=True)
class Print:
    what: Any


@dataclass(frozen=True)
class Block:
    parts: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: Block


@dataclass(frozen=True)
class If:
    test: Any
    then: Block
    other: Block


@dataclass(frozen=True)
class Generation:
    body: Block


# parser

_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[|.+()\[\]]))""")
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
_CONSTANTS = {"true": True, "false": False, "none": None}
_WORDS = {"and", "or", "not", "in"}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"can't read {source[at:]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Precedence climbing: or, and, not, == and !=, +, filters and members."""

    def __init__(self, source: str) -> None:
        self.tokens, self.at = _tokens(source), 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *texts: str) -> str | None:
        kind, text = self.peek()
        if kind in ("op", "name") and text in texts:
            self.at += 1
            return text
        return None

    def need(self, kind: str, text: str | None = None) -> str:
        k, t = self.peek()
        if k != kind or text is not None and t != text:
            raise TemplateError(f"expected {text or kind}, found {t or 'the end'!r}")
        self.at += 1
        return t

    def whole(self) -> Any:
        out = self.either()
        self.need("end")
        return out

    def need_end(self) -> None:
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def either(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = Binary("or", left, self.both())
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.take("and"):
            left = Binary("and", left, self.negated())
        return left

    def negated(self) -> Any:
        return Not(self.negated()) if self.take("not") else self.compared()

    def compared(self) -> Any:
        left = self.added()
        while op := self.take("==", "!="):
            left = Binary(op, left, self.added())
        return left

    def added(self) -> Any:
        left = self.postfix()
        while self.take("+"):
            left = Binary("+", left, self.postfix())
        return left

    def postfix(self) -> Any:
        out = self.primary()
        while op := self.take(".", "[", "|"):
            if op == ".":
                out = Member(out, Const(self.need("name")))
            elif op == "[":
                out = Member(out, self.either())
                self.need("op", "]")
            else:
                out = Filter(out, self.need("name"))
        return out

    def primary(self) -> Any:
        kind, text = self.peek()
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), text[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(text))
        if kind == "name" and text in _CONSTANTS:
            return Const(_CONSTANTS[text])
        if kind == "name" and text not in _WORDS:
            return Name(text)
        if (kind, text) == ("op", "("):
            out = self.either()
            self.need("op", ")")
            return out
        raise TemplateError(f"unexpected {text or 'end'!r}")


def parse(source: str) -> Block:
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in _PARTS.finditer(source):
        pieces.append(("text", source[at: m.start()]))
        if m[1] is not None:
            pieces.append(("print", m[1]))
        elif m[2] is not None:
            pieces.append(("tag", m[2].strip()))
        at = m.end()
    pieces.append(("text", source[at:]))
    place = 0

    def block(*ends: str) -> tuple[Block, str]:
        """Up to one of the tags ``ends``, which is returned."""
        nonlocal place
        parts: list[Any] = []
        while place < len(pieces):
            kind, text = pieces[place]
            place += 1
            if kind == "text":
                parts.append(Print(Const(text)))
            elif kind == "print":
                parts.append(Print(_Expression(text).whole()))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return Block(tuple(parts)), text
                parts.append(tag(word, rest))
        if ends:
            raise TemplateError(f"expected {' or '.join(ends)}, found the end")
        return Block(tuple(parts)), ""

    def tag(word: str, rest: str) -> Any:
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"can't read for {rest!r}")
            return For(m[1], _Expression(m[2]).whole(), block("endfor")[0])
        if word == "if":
            test = _Expression(rest).whole()
            then, end = block("elif", "else", "endif")
            if end.startswith("elif"):
                return If(test, then, Block((tag("if", end[4:]),)))
            return If(test, then, block("endif")[0] if end == "else" else Block(()))
        if word == "generation":
            return Generation(block("endgeneration")[0])
        raise TemplateError(f"unknown tag {word!r}")

    return block()[0]


# constant folding


def fold(node: Any, filters: Mapping[str, Callable[[Any], Any]]) -> Any:
    """The same template with constant expressions computed, dead branches gone and neighbouring texts joined."""
    if isinstance(node, Block):
        parts: list[Any] = []
        for p in (fold(x, filters) for x in node.parts):
            for q in p.parts if isinstance(p, Block) else (p,):
                if isinstance(q, Print) and isinstance(q.what, Const):
                    q = Print(Const(_text(q.what.value)))
                    if not q.what.value:
                        continue
                    if parts and isinstance(parts[-1], Print) and isinstance(parts[-1].what, Const):
                        parts[-1] = Print(Const(parts[-1].what.value + q.what.value))
                        continue
                parts.append(q)
        return Block(tuple(parts))
    if isinstance(node, (Const, Name)):
        return node
    if isinstance(node, If):
        test = fold(node.test, filters)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other, filters)
        return If(test, fold(node.then, filters), fold(node.other, filters))
    node = replace(node, **{k: fold(v, filters) for k, v in vars(node).items() if not isinstance(v, str)})
    inner = [v for v in vars(node).values() if not isinstance(v, str)]
    if isinstance(node, (Filter, Binary, Not)) and all(isinstance(v, Const) for v in inner):
        return Const(_value(node, filters)({}))
    return node


# closures


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def _value(node: Any, filters: Mapping[str, Callable[[Any], Any]]) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        constant = node.value
        return lambda names: constant
    if isinstance(node, Name):
        name = node.name

        def look(names: dict) -> Any:
            if name not in names:
                raise TemplateError(f"unknown name {name!r}")
            return names[name]

        return look
    if isinstance(node, Member):
        of, key = _value(node.of, filters), _value(node.key, filters)

        def member(names: dict) -> Any:
            holder = of(names)
            if type(holder) is not dict:
                raise TemplateError("only mappings have members")
            return holder.get(key(names))

        return member
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        of, apply = _value(node.of, filters), filters[node.name]
        return lambda names: apply(of(names))
    if isinstance(node, Not):
        of = _value(node.of, filters)
        return lambda names: not of(names)
    left, right = _value(node.left, filters), _value(node.right, filters)
    return {
        "+": lambda names: a + b if isinstance(a := left(names), int) and isinstance(b := right(names), int) else _text(a) + _text(right(names)),
        "==": lambda names: left(names) == right(names),
        "!=": lambda names: left(names) != right(names),
        "and": lambda names: left(names) and right(names),
        "or": lambda names: left(names) or right(names),
    }[node.op]


def _writer(node: Any, filters: Mapping[str, Callable[[Any], Any]]) -> Callable[[dict], Iterator[Any]]:
    if isinstance(node, Print):
        value = _value(node.what, filters)

        def write(names: dict) -> Iterator[Any]:
            yield _text(value(names))

        return write
    if isinstance(node, Block):
        parts = [_writer(p, filters) for p in node.parts]

        def each(names: dict) -> Iterator[Any]:
            for part in parts:
                yield from part(names)

        return each
    if isinstance(node, If):
        test, then, other = _value(node.test, filters), _writer(node.then, filters), _writer(node.other, filters)

        def branch(names: dict) -> Iterator[Any]:
            yield from (then if test(names) else other)(names)

        return branch
    if isinstance(node, Generation):
        body = _writer(node.body, filters)

        def marked(names: dict) -> Iterator[Any]:
            yield OPEN
            yield from body(names)
            yield CLOSE

        return marked
    over, body, name = _value(node.over, filters), _writer(node.body, filters), node.name

    def loop(names: dict) -> Iterator[Any]:
        for k, item in enumerate(over(names)):
            yield from body({**names, name: item, "loop": {"index": k + 1, "index0": k, "first": not k}})

    return loop


def compile_template(source: str, filters: Mapping[str, Callable[[Any], Any]] | None = None) -> Callable[[dict], Iterator[Any]]:
    """A closure from names to what the template writes: strings, and ``OPEN`` and ``CLOSE`` around generations."""
    filters = {"trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(), **(filters or {})}
    return _writer(fold(parse(source), filters), filters)
