"""Chat templates: a small sandboxed template language compiled to Python closures.

``{{ m.role }}``, ``{{ m.text | escape }}``, ``'strings'``, ``~`` to join, ``==``, ``!=``,
``and``, ``or``, ``not``; ``{% for m in messages %}``, ``{% if %}``, ``{% else %}``,
``{% generation %}`` and their ends. Nothing else can be named, so a template reaches
only its messages. Constant parts are folded before closures are made.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHAT = (
    "{% for m in messages %}<|im_start|>{{ m.role | name }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)
COLUMNS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"

_opening, _closing = re.compile(r"<(!*)\|"), re.compile(r"<!(!*)\|")
_tag = re.compile(r"\{%\s*(.*?)\s*%\}|\{\{\s*(.*?)\s*\}\}", re.S)
_token = re.compile(r"\s*(?:('[^']*')|(==|!=|~|\||\(|\)|\.)|([A-Za-z_]\w*))")


def escape(text: str) -> str:
    """No ``<|`` is left: one ``!`` is put into every ``<|``, ``<!|``, ``<!!|`` and so on."""
    return _opening.sub(r"<!\1|", text)


def unescape(text: str) -> str:
    return _closing.sub(r"<\1|", text)


def name(text: str) -> str:
    """A role on one line."""
    return escape(text).replace("\n", LINE)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "name": name}
FIELDS = ("role", "text")


class TemplateError(ValueError):
    """A template that the language does not allow."""


class _Expression:
    """Recursive descent over one expression, giving nested tuples."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            found = _token.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(found.group().strip())
            at = found.end()

    def take(self, *wanted: str) -> str | None:
        if self.tokens and self.tokens[0] in wanted:
            return self.tokens.pop(0)
        return None

    def whole(self) -> tuple:
        tree = self.either()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0]!r}")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.joined()
        sign = self.take("==", "!=")
        return (sign, tree, self.joined()) if sign else tree

    def joined(self) -> tuple:
        tree = self.filtered()
        while self.take("~"):
            tree = ("~", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.atom()
        while self.take("|"):
            called = self.tokens.pop(0) if self.tokens else ""
            if called not in FILTERS:
                raise TemplateError(f"no filter {called!r}")
            tree = ("filter", called, tree)
        return tree

    def atom(self) -> tuple:
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        first = self.tokens.pop(0) if self.tokens else ""
        if first.startswith("'"):
            return ("const", first[1:-1])
        if self.take("."):
            field = self.tokens.pop(0) if self.tokens else ""
            if field in FIELDS:
                return ("field", first, field)
        raise TemplateError(f"unknown name {first!r}")


def parse(source: str) -> list[tuple]:
    """The syntax tree: a list of ("text", s), ("print", e), ("for", v, body), ("if", e, yes, no), ("generation", body)."""
    root: list[tuple] = []
    stack: list[tuple[str, tuple, list, list]] = [("", (), root, root)]
    scope: list[str] = []
    at = 0
    for found in _tag.finditer(source):
        body = stack[-1][3]
        if found.start() > at:
            body.append(("text", source[at : found.start()]))
        at = found.end()
        if found.group(2) is not None:
            body.append(("print", _checked(_Expression(found.group(2)).whole(), scope)))
            continue
        words = found.group(1).split()
        head = words[0] if words else ""
        if head == "for" and len(words) == 4 and words[1].isidentifier() and words[2:] == ["in", "messages"] and not scope:
            inner: list[tuple] = []
            scope.append(words[1])
            stack.append(("for", (words[1],), inner, inner))
        elif head == "if":
            inner = []
            stack.append(("if", (_checked(_Expression(found.group(1)[2:]).whole(), scope),), inner, inner))
        elif found.group(1) == "generation":
            if any(s[0] == "generation" for s in stack):
                raise TemplateError("generation within generation")
            inner = []
            stack.append(("generation", (), inner, inner))
        elif found.group(1) == "else" and stack[-1][0] == "if" and stack[-1][2] is stack[-1][3]:
            kind, given, yes, _ = stack.pop()
            stack.append((kind, given, yes, []))
        elif head == f"end{stack[-1][0]}" and len(stack) > 1:
            kind, given, yes, no = stack.pop()
            if kind == "for":
                scope.pop()
            node = (kind, *given, yes, no if no is not yes else []) if kind == "if" else (kind, *given, yes)
            stack[-1][3].append(node)
        else:
            raise TemplateError(f"unexpected {found.group()!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    if at < len(source):
        root.append(("text", source[at:]))
    return root


def _checked(tree: tuple, scope: list[str]) -> tuple:
    if tree[0] == "field" and tree[1] not in scope:
        raise TemplateError(f"unknown name {tree[1]!r}")
    for part in tree[1:]:
        if isinstance(part, tuple):
            _checked(part, scope)
    return tree


def fold(nodes: list[tuple]) -> list[tuple]:
    """The same tree with constant expressions worked out and adjacent texts joined."""
    out: list[tuple] = []
    for node in nodes:
        if node[0] == "print":
            tree = _constant(node[1])
            parts = [("text", str(tree[1]))] if tree[0] == "const" else [("print", tree)]
        elif node[0] == "if":
            tree = _constant(node[1])
            yes, no = fold(node[2]), fold(node[3])
            parts = (yes if tree[1] else no) if tree[0] == "const" else [("if", tree, yes, no)]
        elif node[0] == "text":
            parts = [node]
        else:
            parts = [(*node[:-1], fold(node[-1]))]
        for part in parts:
            if part[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + part[1])
            elif part != ("text", ""):
                out.append(part)
    return out


def _constant(tree: tuple) -> tuple:
    folded = tuple(_constant(p) if isinstance(p, tuple) else p for p in tree)
    inner = [p for p in folded[1:] if isinstance(p, tuple)]
    if inner and all(p[0] == "const" for p in inner):
        return ("const", _value(folded)({}))
    return folded


def _value(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        return lambda _, value=tree[1]: value
    if kind == "field":
        return lambda names, who=tree[1], what=FIELDS.index(tree[2]): names[who][what]
    if kind == "filter":
        return lambda names, f=FILTERS[tree[1]], inner=_value(tree[2]): f(str(inner(names)))
    if kind == "not":
        return lambda names, inner=_value(tree[1]): not inner(names)
    a, b = _value(tree[1]), _value(tree[2])
    return {
        "~": lambda names: f"{a(names)}{b(names)}",
        "==": lambda names: a(names) == b(names),
        "!=": lambda names: a(names) != b(names),
        "and": lambda names: a(names) and b(names),
        "or": lambda names: a(names) or b(names),
    }[kind]


Render = Callable[[dict, Iterator[tuple[str, str]], bool], Iterator[tuple[str, bool]]]


def _rendered(nodes: list[tuple]) -> Render:
    steps = [_step(node) for node in nodes]

    def run(names: dict, messages: Iterator[tuple[str, str]], masked: bool) -> Iterator[tuple[str, bool]]:
        for step in steps:
            yield from step(names, messages, masked)

    return run


def _step(node: tuple) -> Render:
    kind = node[0]
    if kind == "text":
        return lambda names, messages, masked: iter([(node[1], masked)])
    if kind == "print":
        value = _value(node[1])
        return lambda names, messages, masked: iter([(str(value(names)), masked)])
    if kind == "generation":
        body = _rendered(node[1])
        return lambda names, messages, masked: body(names, messages, True)
    if kind == "if":
        test, yes, no = _value(node[1]), _rendered(node[2]), _rendered(node[3])
        return lambda names, messages, masked: (yes if test(names) else no)(names, messages, masked)
    body = _rendered(node[2])

    def loop(names: dict, messages: Iterator[tuple[str, str]], masked: bool) -> Iterator[tuple[str, bool]]:
        for message in messages:
            yield from body({**names, node[1]: message}, messages, masked)

    return loop


@cache
def compiled(source: str) -> Callable[[Iterator[tuple[str, str]]], Iterator[tuple[str, bool]]]:
    """A function from (role, text) messages to the parts of the output, each with whether
    it is under the loss mask. Parts come as messages are read."""
    run = _rendered(fold(parse(source)))
    return lambda messages: run({}, iter(messages), False)


def read_back(parts: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, str, str, int]]:
    """(role, text, text under the mask, characters) of each turn of the CHAT output.

    Only one turn is held at a time.
    """
    turn, under, before = "", [], ""
    for part, masked in parts:
        if masked:
            under.append(part)
        before = turn[-len(END) :]
        turn += part
        # a turn's end can lie only where this part or its seam does
        while (end := turn.find(END, max(0, len(turn) - len(part) - len(before)))) >= 0:
            whole, turn = turn[: end + len(END)], turn[end + len(END) :]
            role, _, text = whole[len(START) : -len(END)].partition("\n")
            yield unescape(role.replace(LINE, "\n")), unescape(text), "".join(map(unescape, under)), len(whole)
            under = []


def digest(messages: Iterator[tuple[str, str]], template: str = CHAT) -> tuple[int, str, int, str, int]:
    """(turns, their hash, masked characters, their hash, characters of the output)."""
    turns, loss = hashlib.sha256(), hashlib.sha256()
    n = chars = size = 0
    for role, text, masked, length in read_back(compiled(template)(messages)):
        turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        loss.update(masked.encode("utf-8", "surrogatepass"))
        n, chars, size = n + 1, chars + len(masked), size + length
    return n, turns.hexdigest(), chars, loss.hexdigest(), size


def _ordered(rows: DataFrame) -> DataFrame:
    picked = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def formatted(conversations: DataFrame, template: str = CHAT) -> DataFrame:
    """(conv_id, formatted, spans): each conversation's output and the start and end of
    every stretch under the loss mask, in code points."""
    compiled(template)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv_id, rows in groupby(_messages(batches), key=lambda r: r[0]):
            out, spans, at = [], [], 0
            for part, masked in compiled(template)((r[2], r[3]) for r in rows):
                if masked:
                    spans.append({"start": at, "stop": at + len(part)})
                out.append(part)
                at += len(part)
            yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "formatted": "".join(out), "spans": spans}], schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
    return _ordered(conversations).mapInArrow(walk, "conv_id long, formatted string, spans array<struct<start:long,stop:long>>")


def digests(conversations: DataFrame, template: str = CHAT) -> DataFrame:
    """Per conversation the columns COLUMNS, read back from its output.

    Turns go through one by one, so a conversation of any length needs the memory of one
    turn. NULL roles and texts are empty; turns that tie are ordered by role and text;
    rows without conv_id form one conversation; other columns are ignored.
    """
    compiled(template)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for conv_id, rows in groupby(_messages(batches), key=lambda r: r[0]):
            found.append((conv_id, *digest(((r[2], r[3]) for r in rows), template)))
            if len(found) >= 1024:
                yield _packed(found)
                found = []
        yield _packed(found)

    return _ordered(conversations).mapInArrow(walk, COLUMNS)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in COLUMNS.split(", ")])
