"""A small sandboxed template language: text to syntax tree to Python closures.

    {{ expression }}                     put a value
    {% if e %} {% elif e %} {% else %} {% endif %}
    {% for x in messages %} {% endfor %}
    {% generation %} {% endgeneration %} marks what the model is trained on

Expressions have texts, whole numbers, ``true``, ``false``, names, fields of a
loop's item (``x.role``, ``x['role']``), ``loop.first``, ``loop.last``,
``loop.index``, ``+`` of texts, ``==``, ``!=``, ``not``, ``and``, ``or``,
parentheses, and the filters in ``FILTERS`` after a ``|``. Nothing else can be
reached: no attribute of a Python object, no call, no import.

What does not depend on the input is computed while compiling. A loop reads its
items one by one and looks one ahead for ``loop.last``, so a conversation of any
length is rendered in constant memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

# "<|" opens a control string; a backslash after "<" takes that from it.
_OPENS = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    """The text without any "<|"; undone by :func:`unescape`."""
    return _OPENS.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: Any
    name: str


@dataclass(frozen=True)
class Op:
    kind: str  # + == != not and or, or a filter's name
    args: tuple


@dataclass(frozen=True)
class Put:
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    item: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TOKENS = re.compile(
    r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)"""
    r"""|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|[+|().\[\]]))"""
)
_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def whole(self):
        found = self.any_of()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "text":
            if self.tokens[self.at][1] in wanted:
                self.at += 1
                return self.tokens[self.at - 1][1]
        return None

    def need(self, kind: str) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"a {kind} is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def chain(self, marks: tuple[str, ...], part: Callable):
        found = part()
        while mark := self.take(*marks):
            found = Op(mark, (found, part()))
        return found

    def any_of(self):
        return self.chain(("or",), lambda: self.chain(("and",), self.negated))

    def negated(self):
        if self.take("not"):
            return Op("not", (self.negated(),))
        return self.chain(("==", "!="), lambda: self.chain(("+",), self.filtered))

    def filtered(self):
        found = self.atom()
        while self.take("|"):
            name = self.need("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            found = Op(name, (found,))
        return found

    def atom(self):
        if self.take("("):
            found = self.any_of()
            if not self.take(")"):
                raise TemplateError("a ) is missing")
            return found
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Const(_text(value))
        if kind == "number":
            return Const(int(value))
        if kind != "name" or value in ("and", "or", "not"):
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false"):
            return Const(value == "true")
        found = Name(value)
        while mark := self.take(".", "["):
            if mark == ".":
                found = Field(found, self.need("name"))
            else:
                found = Field(found, _text(self.need("text")))
                if not self.take("]"):
                    raise TemplateError("a ] is missing")
        return found


def _text(quoted: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), quoted[1:-1], flags=re.S)


def parse(source: str) -> tuple:
    """The syntax tree: a tuple of statements."""
    pieces = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        body = []
        while at < len(pieces):
            piece = pieces[at]
            at += 1
            if piece.startswith("{{") and piece.endswith("}}"):
                body.append(Put(_Expression(piece[2:-2]).whole()))
            elif piece.startswith("{%") and piece.endswith("%}"):
                word, _, rest = piece[2:-2].strip().partition(" ")
                if word in ends:
                    return tuple(body), f"{word} {rest}"
                body.append(statement(word, rest))
            elif piece:
                body.append(Put(Const(piece)))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(body), ""

    def statement(word: str, rest: str):
        if word == "generation":
            return Generation(block("endgeneration")[0])
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            return For(m[1], _Expression(m[2]).whole(), block("endfor")[0])
        if word == "if":
            return branch(rest)
        raise TemplateError(f"unknown statement {word!r}")

    def branch(test: str) -> If:
        then, end = block("elif", "else", "endif")
        word, _, rest = end.partition(" ")
        if word == "elif":
            other = (branch(rest),)
        else:
            other = block("endif")[0] if word == "else" else ()
        return If(_Expression(test).whole(), then, other)

    return block()[0]


def _apply(kind: str, args: list) -> Any:
    if kind == "not":
        return not args[0]
    if kind == "==":
        return args[0] == args[1]
    if kind == "!=":
        return args[0] != args[1]
    if kind == "+":
        return str(args[0]) + str(args[1])
    return FILTERS[kind](str(args[0]))


def fold(node):
    """The expression or statement with everything constant computed."""
    if isinstance(node, Op):
        args = tuple(fold(a) for a in node.args)
        if node.kind in ("and", "or"):
            if isinstance(args[0], Const):
                decided = bool(args[0].value) == (node.kind == "or")
                return args[0] if decided else args[1]
        elif all(isinstance(a, Const) for a in args):
            return Const(_apply(node.kind, [a.value for a in args]))
        return Op(node.kind, args)
    if isinstance(node, Put):
        return Put(fold(node.value))
    if isinstance(node, Generation):
        return Generation(fold_all(node.body))
    if isinstance(node, For):
        return For(node.item, fold(node.over), fold_all(node.body))
    if isinstance(node, If):
        return If(fold(node.test), fold_all(node.then), fold_all(node.other))
    return node


def fold_all(body: tuple) -> tuple:
    """Folded statements; decided branches are taken and neighbouring texts joined."""
    out: list = []
    for node in map(fold, body):
        if isinstance(node, If) and isinstance(node.test, Const):
            inner = node.then if node.test.value else node.other
        else:
            inner = (node,)
        for x in inner:
            constant = isinstance(x, Put) and isinstance(x.value, Const)
            last = out[-1] if out else None
            if constant and isinstance(last, Put) and isinstance(last.value, Const):
                out[-1] = Put(Const(str(last.value.value) + str(x.value.value)))
            else:
                out.append(x)
    return tuple(out)


Render = Callable[[dict, bool], Iterator[tuple[str, bool]]]


def _value(node) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        def named(scope, name=node.name):
            if name not in scope:
                raise TemplateError(f"no value {name!r}")
            return scope[name]

        return named
    if isinstance(node, Field):
        of = _value(node.of)

        def field(scope, name=node.name):
            owner = of(scope)
            if not isinstance(owner, dict) or name not in owner:
                raise TemplateError(f"no field {name!r}")
            return owner[name]

        return field
    args = [_value(a) for a in node.args]
    if node.kind == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.kind == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    return lambda scope, kind=node.kind: _apply(kind, [a(scope) for a in args])


def _statement(node) -> Render:
    if isinstance(node, Put):
        value = _value(node.value)

        def put(scope, trained):
            yield str(value(scope)), trained

        return put
    if isinstance(node, Generation):
        body = _body(node.body)
        return lambda scope, trained: body(scope, True)
    if isinstance(node, If):
        test, then, other = _value(node.test), _body(node.then), _body(node.other)
        return lambda scope, trained: (then if test(scope) else other)(scope, trained)
    over, body = _value(node.over), _body(node.body)

    def loop(scope, trained):
        items = iter(over(scope))
        nothing = object()
        ahead, index = next(items, nothing), 0
        while ahead is not nothing:
            item, ahead, index = ahead, next(items, nothing), index + 1
            about = {"first": index == 1, "last": ahead is nothing, "index": index}
            yield from body({**scope, node.item: item, "loop": about}, trained)

    return loop


def _body(nodes: tuple) -> Render:
    parts = [_statement(n) for n in nodes]

    def run(scope, trained):
        for part in parts:
            yield from part(scope, trained)

    return run


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[tuple[str, bool]]]:
    """A function from messages to pieces of text and whether each is trained on."""
    body = _body(fold_all(parse(source)))
    return lambda messages: body({"messages": messages}, False)
