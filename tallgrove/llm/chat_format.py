"""Chat formatting: templates are parsed into a tree, folded, and compiled to Python closures.

The language is sandboxed: text, ``{{ expression }}``, ``{% if %} {% elif %} {% else %} {% endif %}``,
``{% for name in expression %} {% endfor %}`` and ``{% generation %} {% endgeneration %}`` around what a model has to
learn. Expressions know literals, names, fields of messages, ``loop.first / last / index``, comparisons, ``and``, ``or``,
``not``, ``~`` and the filters of ``FILTERS``; they reach no attribute, call or module of Python.

Conversations are shuffled by id, sorted by turn and rendered turn by turn, so one that holds a
large part of all turns needs no more memory than its longest turn.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrove.llm.frames import ready

#: Marks each turn; control strings cannot arise in texts, in which ``\\``, ``#`` and ``<`` are escaped.
TEMPLATE = (
    "{% for m in messages %}### {{ m.role | guard_name }}: "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | guard }}{% endgeneration %}"
    "{% else %}{{ m.text | guard }}{% endif %}</turn>\n{% endfor %}"
)
TURN = re.compile(
    r"### ([^\\:]*+(?:\\.[^\\:]*+)*+): ([^\\<]*+(?:\\.[^\\<]*+)*+)</turn>\n", re.DOTALL
)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def guard(text: str) -> str:
    return re.sub(r"[\\#<]", r"\\\g<0>", text)


def guard_name(text: str) -> str:
    return re.sub(r"[\\#<:]", r"\\\g<0>", text)


def unguard(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "guard": guard,
    "guard_name": guard_name,
    "upper": str.upper,
    "lower": str.lower,
    "trim": str.strip,
}


class TemplateError(ValueError):
    """A template that the language does not know."""


class Literal(NamedTuple):
    value: Any


class Name(NamedTuple):
    path: tuple[str, ...]


class Filter(NamedTuple):
    name: str
    inner: Any


class Op(NamedTuple):
    name: str
    parts: tuple


class Text(NamedTuple):
    text: str


class Show(NamedTuple):
    value: Any


class If(NamedTuple):
    test: Any
    then: tuple
    other: tuple


class For(NamedTuple):
    name: str
    source: Any
    body: tuple


class Generation(NamedTuple):
    body: tuple


TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
TOKEN = re.compile(r"""\s*(?:('(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|.~()]))""", re.DOTALL)


class Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, Any]] = []
        at, source = 0, source.strip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            quoted, number, word, sign = found.groups()
            if quoted is not None:
                self.tokens.append(("value", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), quoted[1:-1])))
            elif number is not None:
                self.tokens.append(("value", int(number)))
            elif word in ("true", "false", "none"):
                self.tokens.append(("value", {"true": True, "false": False, "none": None}[word]))
            else:
                self.tokens.append(("word" if word else "sign", word or sign))
            at = found.end()
        self.at = 0

    def peek(self) -> tuple[str, Any]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, *values: str) -> Any:
        kind, value = self.peek()
        if kind in ("word", "sign") and value in values:
            self.at += 1
            return value
        return None

    def whole(self) -> Any:
        tree = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return tree

    def either(self) -> Any:
        parts = [self.both()]
        while self.take("or"):
            parts.append(self.both())
        return parts[0] if len(parts) == 1 else Op("or", tuple(parts))

    def both(self) -> Any:
        parts = [self.negated()]
        while self.take("and"):
            parts.append(self.negated())
        return parts[0] if len(parts) == 1 else Op("and", tuple(parts))

    def negated(self) -> Any:
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        left = self.joined()
        sign = self.take("==", "!=")
        return Op(sign, (left, self.joined())) if sign else left

    def joined(self) -> Any:
        parts = [self.filtered()]
        while self.take("~"):
            parts.append(self.filtered())
        return parts[0] if len(parts) == 1 else Op("~", tuple(parts))

    def filtered(self) -> Any:
        tree = self.atom()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "word" or name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            self.at += 1
            tree = Filter(name, tree)
        return tree

    def atom(self) -> Any:
        kind, value = self.peek()
        self.at += 1
        if kind == "value":
            return Literal(value)
        if kind == "sign" and value == "(":
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return tree
        if kind != "word" or value in ("and", "or", "not"):
            raise TemplateError(f"unexpected {value!r}")
        path = [value]
        while self.take("."):
            kind, field = self.peek()
            if kind != "word" or field.startswith("_"):
                raise TemplateError(f"no such field: {field!r}")
            path.append(field)
            self.at += 1
        return Name(tuple(path))


def parse(source: str) -> tuple:
    """The template's tree: a tuple of nodes."""
    parts: list[tuple[str, str]] = []
    at = 0
    for found in TAG.finditer(source):
        if found.start() > at:
            parts.append(("text", source[at : found.start()]))
        parts.append(("show", found[1]) if found[1] is not None else ("tag", found[2].strip()))
        at = found.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    stream = iter(parts)

    def block(*ends: str) -> tuple[tuple, str]:
        nodes: list = []
        for kind, value in stream:
            if kind == "text":
                nodes.append(Text(value))
                continue
            if kind == "show":
                nodes.append(Show(Expression(value).whole()))
                continue
            word, _, rest = value.partition(" ")
            if word in ends:
                return tuple(nodes), value
            if word == "if":
                nodes.append(branch(rest))
            elif word == "for":
                found = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.*)", rest.strip(), re.DOTALL)
                if not found:
                    raise TemplateError(f"cannot read {value!r}")
                nodes.append(For(found[1], Expression(found[2]).whole(), block("endfor")[0]))
            elif word == "generation":
                nodes.append(Generation(block("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected {value!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(nodes), ""

    def branch(test: str) -> If:
        then, end = block("elif", "else", "endif")
        if end.startswith("elif"):
            return If(Expression(test).whole(), then, (branch(end[4:]),))
        other = block("endif")[0] if end == "else" else ()
        return If(Expression(test).whole(), then, other)

    return block()[0]


def shown(value: Any) -> str:
    return "" if value is None else str(value)


def operate(name: str, values: Iterator[Any]) -> Any:
    if name == "or":
        return next((v for v in values if v), False)
    if name == "and":
        return next((v for v in values if not v), True)
    if name == "not":
        return not next(values)
    if name == "~":
        return "".join(map(shown, values))
    left, right = values
    return (left == right) == (name == "==")


def fold(tree: Any) -> Any:
    """The same tree with everything known beforehand worked out and neighbouring texts joined."""
    if isinstance(tree, Filter):
        inner = fold(tree.inner)
        return Literal(FILTERS[tree.name](shown(inner.value))) if isinstance(inner, Literal) else Filter(tree.name, inner)
    if isinstance(tree, Op):
        parts = tuple(map(fold, tree.parts))
        known = all(isinstance(p, Literal) for p in parts)
        return Literal(operate(tree.name, (p.value for p in parts))) if known else Op(tree.name, parts)
    return tree


def fold_block(nodes: Iterable) -> tuple:
    out: list = []
    for node in nodes:
        if isinstance(node, Show):
            value = fold(node.value)
            more = [Text(shown(value.value))] if isinstance(value, Literal) else [Show(value)]
        elif isinstance(node, If):
            test, then, other = fold(node.test), fold_block(node.then), fold_block(node.other)
            more = list(then if test.value else other) if isinstance(test, Literal) else [If(test, then, other)]
        elif isinstance(node, For):
            more = [For(node.name, fold(node.source), fold_block(node.body))]
        elif isinstance(node, Generation):
            more = [Generation(fold_block(node.body))]
        else:
            more = [node]
        for new in more:
            if isinstance(new, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + new.text)
            elif new != Text(""):
                out.append(new)
    return tuple(out)


Pieces = Iterator[tuple[str, bool, bool]]  # text, whether it is generated, whether an item of the outer loop ends here


def value_of(tree: Any) -> Callable[[dict], Any]:
    if isinstance(tree, Literal):
        return lambda env, v=tree.value: v
    if isinstance(tree, Name):
        first, rest = tree.path[0], tree.path[1:]

        def look(env: dict) -> Any:
            value = env.get(first)
            for field in rest:
                value = value.get(field) if isinstance(value, dict) else None
            return value

        return look
    if isinstance(tree, Filter):
        inner, filter_ = value_of(tree.inner), FILTERS[tree.name]
        return lambda env: filter_(shown(inner(env)))
    parts = [value_of(p) for p in tree.parts]
    return lambda env, name=tree.name: operate(name, (p(env) for p in parts))


def closure_of(nodes: tuple, generated: bool = False, depth: int = 0) -> Callable[[dict], Pieces]:
    """A generator function that writes the block's pieces for the names it is given."""
    steps: list[Callable[[dict], Pieces]] = []
    for node in nodes:
        if isinstance(node, Text):
            steps.append(lambda env, text=node.text: iter([(text, generated, False)]))
        elif isinstance(node, Show):
            steps.append(lambda env, value=value_of(node.value): iter([(shown(value(env)), generated, False)]))
        elif isinstance(node, Generation):
            steps.append(closure_of(node.body, True, depth))
        elif isinstance(node, If):
            test, then, other = value_of(node.test), closure_of(node.then, generated, depth), closure_of(node.other, generated, depth)
            steps.append(lambda env, test=test, then=then, other=other: then(env) if test(env) else other(env))
        else:
            steps.append(loop_of(node, generated, depth))
    return lambda env: itertools.chain.from_iterable(step(env) for step in steps)


#: Behind the last item of a loop; an item may be null.
END = object()


def loop_of(node: For, generated: bool, depth: int) -> Callable[[dict], Pieces]:
    source, body = value_of(node.source), closure_of(node.body, generated, depth + 1)

    def run(env: dict) -> Pieces:
        items = iter(source(env) or ())
        item, more = next(items, END), True
        if item is END:
            return
        for index in itertools.count(1):
            following = next(items, END)
            more = following is not END
            loop = {"index": index, "first": index == 1, "last": not more}
            yield from body({**env, node.name: item, "loop": loop})
            if not depth:
                yield "", generated, True
            if not more:
                return
            item = following

    return run


def compile_template(source: str) -> Callable[[dict], Pieces]:
    return closure_of(fold_block(parse(source)))


SPANS = "array<struct<start:bigint,end:bigint>>"


def format_turns(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, place, piece, spans): the formatted text of each conversation in pieces, one a turn.

    ``spans`` are the code points of the piece under the loss mask. Pieces stay in order in their partition. Rows are
    ordered by turn (null first), ties by role and text; null roles and texts are empty; rows
    without a conv_id are one conversation. An empty table gives no rows; other columns are not read.
    """
    ready(conversations.sparkSession)
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        turns = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out: list[list] = [[], [], [], []]
        held = 0

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), kind)
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], names=["conv_id", "place", "piece", "spans"]
            )
            for column in out:
                column.clear()
            return made

        for conv, group in itertools.groupby(turns, key=lambda row: row[0]):
            messages = ({"turn": turn, "role": role, "text": text} for _, turn, role, text in group)
            parts, spans, at, place = [], [], 0, 0
            for text, generated, ends in itertools.chain(render({"messages": messages}), [("", False, True)]):
                if text:
                    if generated:
                        spans.append({"start": at, "end": at + len(text)})
                    parts.append(text)
                    at += len(text)
                if ends and parts:
                    for column, value in zip(out, (conv, place, "".join(parts), spans)):
                        column.append(value)
                    held, place = held + at, place + 1
                    parts, spans, at = [], [], 0
                    if held > 4_000_000:
                        yield batch_of()
                        held = 0
        yield batch_of()

    return order.mapInArrow(run, f"conv_id long, place long, piece string, spans {SPANS}")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the conversations, read from the output of ``format_turns`` with ``TEMPLATE``.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars. Text that the marks do
    not explain is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        found: list[list] = [[] for _ in range(6)]
        for conv, group in itertools.groupby(rows, key=lambda row: row[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n, lost, total = 0, 0, 0
            for _, _, piece, spans in group:
                at = 0
                while at < len(piece):
                    turn = TURN.match(piece, at)
                    if not turn:
                        raise ValueError(f"conversation {conv}: no turn at {piece[at : at + 40]!r}")
                    turns.update(f"{unguard(turn[1])}\n{unguard(turn[2])}\n".encode())
                    n, at = n + 1, turn.end()
                for span in spans:
                    text = unguard(piece[span["start"] : span["end"]])
                    loss.update(text.encode())
                    lost += len(text)
                total += len(piece)
            for column, value in zip(found, (conv, n, turns.hexdigest(), lost, loss.hexdigest(), total)):
                column.append(value)
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=names)

    return formatted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
