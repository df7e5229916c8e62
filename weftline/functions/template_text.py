"""Chat templates given as text, compiled to column expressions.

The language is the part of the usual template syntax that plain chat templates
need: text, ``{{ output }}``, ``{% if %}``, one ``{% for message in messages %}``,
``{% generation %}`` around what is trained on, and ``raise_exception`` for a chat
that breaks the template's rules. Compiling happens once, where the plan is made;
rows are rendered by the resulting expressions, without Python workers.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.templates import SEGMENTS, RenderOptions, Template
from weftline.functions.text import strip

TAG = re.compile(r"\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#.*?#\}", re.DOTALL)
WORD = re.compile(r"""\s*("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|\d+|\w+|==|!=|[\[\]().|+~,])""")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
FILTERS = {"trim": strip, "upper": F.upper, "lower": F.lower}


class TemplateTextError(ValueError):
    """The text is not of the language, or asks for what a template cannot know."""


@dataclass
class Node:
    kind: str  # text, output, error, if, for, generation
    value: str = ""
    branches: list[tuple[str | None, list[Node]]] = field(default_factory=list)

    @property
    def body(self) -> list[Node]:
        return self.branches[0][1]

    def has(self, kind: str) -> bool:
        return self.kind == kind or any(n.has(kind) for _, nodes in self.branches for n in nodes)


@dataclass(frozen=True)
class Scope:
    """What names mean at one place of the template."""

    options: RenderOptions
    messages: Column | None = None
    message: Column | None = None
    index: Column | None = None


@dataclass(frozen=True)
class Value:
    """A column, and whether it is a condition; a text is true unless it is empty."""

    column: Column
    condition: bool = False

    def true(self) -> Column:
        return F.coalesce(self.column if self.condition else self.column.cast("string") != "", F.lit(False))


# --- text to nodes -----------------------------------------------------------


def _pieces(source: str) -> list[tuple[str, str]]:
    """(kind, content): text, output and block tags, white space removed as asked.

    A line break after a block tag goes, and so does white space between the
    start of a line and a block tag; a dash removes all on its side.
    """
    out: list[tuple[str, str]] = []
    at, eat = 0, ""
    for tag in [*TAG.finditer(source), None]:
        text = source[at : tag.start() if tag else len(source)]
        opens_line = at == 0 or (eat == "\n" and text.startswith("\n"))
        if eat:
            text = text.lstrip() if eat == "-" else text.removeprefix("\n")
        if tag and tag.group()[2] == "-":
            text = text.rstrip()
        elif tag and tag.group()[1] != "{":
            text = re.sub(r"(^|\n)[ \t]+\Z" if opens_line else r"(\n)[ \t]+\Z", r"\1", text)
        if text:
            out.append(("text", text))
        if tag:
            found, at = tag.group(), tag.end()
            eat = "-" if found[-3] == "-" else "" if found[1] == "{" else "\n"
            if found[1] != "#":
                out.append(("output" if found[1] == "{" else "block", found[2:-2].strip("-").strip()))
    return out


def parse(source: str) -> list[Node]:
    nodes: list[Node] = []
    stack: list[tuple[Node | None, list[Node]]] = [(None, nodes)]
    for kind, content in _pieces(source):
        here = stack[-1][1]
        if kind == "text":
            here.append(Node("text", content))
        elif kind == "output":
            raised = re.fullmatch(r"raise_exception\((.*)\)", content, re.DOTALL)
            here.append(Node("error", raised.group(1)) if raised else Node("output", content))
        else:
            name, _, rest = content.partition(" ")
            opener = stack[-1][0]
            if name in ("if", "generation", "for"):
                if name == "for" and (rest.split() != ["message", "in", "messages"] or len(stack) > 1):
                    raise TemplateTextError(f"only messages are looped over, and not inside a block: {content}")
                node = Node(name, branches=[(rest if name == "if" else None, [])])
                here.append(node)
                stack.append((node, node.body))
            elif name in ("elif", "else") and opener is not None and opener.kind == "if":
                opener.branches.append((rest if name == "elif" else None, []))
                stack[-1] = (opener, opener.branches[-1][1])
            elif opener is not None and content == f"end{opener.kind}":
                stack.pop()
            else:
                raise TemplateTextError(f"unexpected {content!r}")
    if len(stack) > 1:
        raise TemplateTextError(f"{stack[-1][0].kind} is not closed")
    return nodes


# --- expressions -------------------------------------------------------------


class Expression:
    """One expression, read from left to right into a column."""

    def __init__(self, source: str, scope: Scope):
        self.source, self.scope, self.at = source, scope, 0
        self.words: list[str] = []
        end = 0
        while source[end:].strip():
            found = WORD.match(source, end)
            if not found:
                raise TemplateTextError(f"cannot read {source!r}")
            self.words.append(found.group(1))
            end = found.end()

    def value(self) -> Value:
        value = self.either()
        if self.at < len(self.words):
            raise self.wrong()
        return value

    def column(self) -> Column:
        return self.value().column

    def condition(self) -> Column:
        return self.value().true()

    def wrong(self) -> TemplateTextError:
        return TemplateTextError(f"cannot read {self.source!r}")

    def next(self, *wanted: str) -> str | None:
        """The next word, if it is one of those wanted (any, if none are)."""
        if self.at < len(self.words) and (not wanted or self.words[self.at] in wanted):
            self.at += 1
            return self.words[self.at - 1]
        return None

    def either(self) -> Value:
        value = self.both()
        while self.next("or"):
            value = Value(value.true() | self.both().true(), True)
        return value

    def both(self) -> Value:
        value = self.negated()
        while self.next("and"):
            value = Value(value.true() & self.negated().true(), True)
        return value

    def negated(self) -> Value:
        return Value(~self.negated().true(), True) if self.next("not") else self.compared()

    def compared(self) -> Value:
        value = self.joined()
        sign = self.next("==", "!=")
        if not sign:
            return value
        same = value.column.eqNullSafe(self.joined().column)
        return Value(same if sign == "==" else ~same, True)

    def joined(self) -> Value:
        parts = [self.filtered()]
        while self.next("+", "~"):
            parts.append(self.filtered())
        return parts[0] if len(parts) == 1 else Value(F.concat(*[p.column for p in parts]))

    def filtered(self) -> Value:
        value = self.single()
        while self.next("|"):
            name = self.next()
            if name not in FILTERS:
                raise TemplateTextError(f"no filter {name!r}")
            value = Value(FILTERS[name](value.column))
        return value

    def single(self) -> Value:
        word = self.next()
        if word is None:
            raise self.wrong()
        if word == "(":
            value = self.either()
            if not self.next(")"):
                raise self.wrong()
            return value
        if word[0] in "'\"":
            return Value(F.lit(unquoted(word)))
        if word.isdigit():
            return Value(F.lit(int(word)))
        return self.named(word)

    def key(self) -> str:
        """The field after a name: ``.role`` or ``['role']``."""
        if self.next("."):
            return self.next() or ""
        if self.next("["):
            word = self.next() or ""
            if self.next("]"):
                return unquoted(word) if word[:1] in ("'", '"') else word
        raise self.wrong()

    def named(self, name: str) -> Value:
        s, o = self.scope, self.scope.options
        known = {
            "bos_token": o.bos,
            "eos_token": o.eos,
            "add_generation_prompt": o.add_generation_prompt,
            "default_system": o.default_system or "",
            "true": True,
            "false": False,
        }
        if name in known:
            return Value(F.lit(known[name]), isinstance(known[name], bool))
        if name == "message" and s.message is not None:
            return _field(s.message, self.key())
        if name == "messages" and s.messages is not None:
            at = self.key()
            if at.isdigit():
                return _field(F.get(s.messages, F.lit(int(at))), self.key())
        if name == "loop" and s.index is not None:
            values = {"index0": Value(s.index), "index": Value(s.index + 1), "first": Value(s.index == 0, True)}
            if (key := self.key()) in values:
                return values[key]
        raise TemplateTextError(f"{name!r} is not known here: {self.source!r}")


def unquoted(word: str) -> str:
    return re.sub(r"\\(.)", lambda m: ESCAPES.get(m.group(1), m.group(1)), word[1:-1], flags=re.DOTALL)


def _field(message: Column, name: str) -> Value:
    if name == "content":
        return Value(F.coalesce(message["content"], F.lit("")))
    if name == "role":
        return Value(message["role"])
    raise TemplateTextError(f"a message has no {name!r}")


# --- nodes to columns --------------------------------------------------------


def _text_of(nodes: list[Node], scope: Scope) -> Column:
    """The text of nodes without a generation among them."""
    parts = []
    for n in nodes:
        if n.kind == "text":
            parts.append(F.lit(n.value))
        elif n.kind == "output":
            parts.append(F.coalesce(Expression(n.value, scope).column().cast("string"), F.lit("")))
        elif n.kind == "if":
            parts.append(_choice(n, scope, _text_of, F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def _choice(node: Node, scope: Scope, of: Callable[[list[Node], Scope], Column], nothing: Column) -> Column:
    value = nothing
    for condition, nodes in reversed(node.branches):
        inside = of(nodes, scope)
        value = inside if condition is None else F.when(Expression(condition, scope).condition(), inside).otherwise(value)
    return value


def _segment(text: Column, trainable: bool) -> Column:
    one = F.struct(text.alias("text"), F.lit(trainable).alias("trainable"))
    return F.when(text == "", F.array().cast(SEGMENTS)).otherwise(F.array(one).cast(SEGMENTS))


def _segments_of(nodes: list[Node], scope: Scope) -> Column:
    """Segments; text that is not interrupted by a generation is one segment."""
    parts, open_nodes = [], []

    def close() -> None:
        if open_nodes:
            parts.append(_segment(_text_of(open_nodes, scope), False))
            open_nodes.clear()

    for n in nodes:
        if not n.has("generation"):
            open_nodes.append(n)
            continue
        close()
        if n.kind == "generation":
            parts.append(_segment(_text_of(n.body, scope), True))
        else:
            parts.append(_choice(n, scope, _segments_of, F.array().cast(SEGMENTS)))
    close()
    return F.concat(*parts) if parts else F.array().cast(SEGMENTS)


def _error_of(nodes: list[Node], scope: Scope) -> Column:
    """The first error that is raised, null if none is."""
    none = F.lit(None).cast("string")
    found = []
    for n in nodes:
        if n.kind == "error":
            found.append(Expression(n.value, scope).column())
        elif n.kind == "if" and n.has("error"):
            found.append(_choice(n, scope, _error_of, none))
        elif n.kind == "generation":
            found.append(_error_of(n.body, scope))
    return reduce(lambda a, b: F.coalesce(a, b), found, none)


def compile_template(source: str) -> Template:
    """A template from its text, for use wherever a template's name is.

    Values of messages are ``role`` and ``content``; ``bos_token``, ``eos_token``,
    ``add_generation_prompt`` and ``default_system`` come from the render options,
    ``messages[0]`` may be looked at before the loop, and ``loop.first`` and
    ``loop.index0`` inside it. ``raise_exception('code')`` gives the chat an error
    code. What is not of the language is refused here, before any row is read.
    """
    nodes = parse(source)
    loops = [k for k, n in enumerate(nodes) if n.kind == "for"]
    if len(loops) != 1:
        raise TemplateTextError("a template has one loop over its messages")
    before, loop, after = nodes[: loops[0]], nodes[loops[0]].body, nodes[loops[0] + 1 :]

    def head(messages: Column, o: RenderOptions) -> Column:
        return _segments_of(before, Scope(o, messages))

    def message(m: Column, i: Column, o: RenderOptions) -> Column:
        return _segments_of(loop, Scope(o, None, m, i))

    def tail(o: RenderOptions) -> Column:
        return _segments_of(after, Scope(o))

    def error(messages: Column) -> Column:
        o = RenderOptions()
        each = F.transform(messages, lambda m, i: _error_of(loop, Scope(o, None, m, i)))
        inside = F.get(F.filter(each, lambda e: e.isNotNull()), F.lit(0))
        return F.coalesce(_error_of(before, Scope(o, messages)), inside)

    # Compiled once on sample values, so that mistakes show now.
    sample, options = F.array(F.struct(F.lit("").alias("role"), F.lit("").alias("content"))), RenderOptions()
    head(sample, options), message(F.get(sample, F.lit(0)), F.lit(0), options), tail(options), error(sample)
    return Template(head, message, tail, error)
