"""Source text of a brace language into two relations: calls and statements.

One left-to-right pass over quotes, comments, brackets and separators; what
lies between them is never looked at twice.  Each file is read on its own, so
files spread over tasks as the rows that hold them do.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from ..plans.tables import settled

LEXEME = re.compile(r"""(?P<text>"(?:\\.|[^"\\])*"?|'(?:\\.|[^'\\])*'?)|(?P<note>//[^\n]*|/\*.*?(?:\*/|\Z))|(?P<mark>[()\[\]{},;])""", re.S)
CALLEE = re.compile(r"(?:\b(?P<new>new)\s+)?(?P<path>\.?\s*[A-Za-z_]\w*(?:\s*\.\s*\w+)*)\s*(?:<[\w\s,.<>?]*>)?\s*$")
TARGET = re.compile(r"(?:(?P<type>[\w.]+(?:<[\w\s,.<>?]*>)?(?:\[\])?)\s+)?(?P<name>(?:this\.)?[A-Za-z_]\w*)\s*=(?!=)\s*", re.S)
METHOD = re.compile(r"(\w+)\s*\([^()]*\)\s*(?:throws\s+[\w\s,.]+)?$", re.S)
CLASS = re.compile(r"\bclass\s+(\w+)(?:\s+extends\s+([\w.]+))?")
PAIRS = {")": "(", "]": "[", "}": "{"}
SKIPPED = {"if", "for", "while", "switch", "catch", "return"}

COLUMNS = (
    "kind string, pos int, until int, name string, is_new boolean, receiver string, on_call int, args array<string>, parent int, parent_arg int, "
    "target string, type string, expression string, method string, in_class string, base string"
)
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
ARROW = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
#: Rows that a worker holds before it hands them on, and those of the largest file.
ROWS = 1024


def _chain_start(source: str, low: int, high: int) -> int:
    """From where up to `high` a name, a chain of names or types can reach, of any length."""
    while high > low and (source[high - 1].isalnum() or source[high - 1].isspace() or source[high - 1] in "_.<>,?"):
        high -= 1
    return high


def without_comments(source: str) -> str:
    """Comments go, their line breaks and all quoted text stay."""
    return LEXEME.sub(lambda m: "\n" * m[0].count("\n") if m["note"] else m[0], source)


@dataclass
class Frame:
    """An open bracket: where it stands, what was called, where its parts began."""

    mark: str
    at: int
    call: dict | None = None
    cuts: list[int] = field(default_factory=list)
    method: str | None = None
    in_class: str | None = None
    base: str | None = None


def arguments(source: str, opening: int) -> list[str] | None:
    """The parts between the bracket at `opening` and the one that closes it; null where nothing does."""
    depth, cuts = 0, [opening]
    for m in LEXEME.finditer(source, opening):
        mark = m["mark"]
        if mark in ("(", "[", "{"):
            depth += 1
        elif mark in PAIRS:
            depth -= 1
            if depth == 0:
                parts = [source[a + 1 : b].strip() for a, b in zip(cuts, [*cuts[1:], m.start()], strict=True)]
                return parts if parts != [""] else []
        elif mark == "," and depth == 1:
            cuts.append(m.start())
    return None


def relations(source: str) -> list[dict]:
    """Rows of both relations; a bracket that is never closed gives no row."""
    text, out = without_comments(source), []
    stack = [Frame("", -1)]
    ended: dict[int, int] = {}  # where a call ends: where it began
    start = 0  # of the statement
    for m in LEXEME.finditer(text):
        mark, at = m["mark"], m.start()
        if mark is None:
            continue
        top = stack[-1]
        here = {"method": top.method, "in_class": top.in_class, "base": top.base}
        if mark in ("(", "[", "{"):
            frame = Frame(mark, at, cuts=[at], **here)
            before = text[start:at]
            if mark == "{":
                head = before.strip()
                if c := CLASS.search(head):
                    frame.in_class, frame.base, frame.method = c[1], c[2], None
                elif (f := METHOD.search(head)) and f[1] not in SKIPPED and not re.search(r"\bnew\s+[\w.]+\s*\([^()]*\)$", head):
                    frame.method = f[1]
                if not any(f.mark in "([" and f.mark for f in stack):
                    start = at + 1
            elif mark == "(" and (c := CALLEE.search(text[(low := _chain_start(text, start, at)) : at])):
                path = re.sub(r"\s+", "", c["path"])
                begin = low + c.start()
                chain = len(text[:begin].rstrip()) if path.startswith(".") else None
                parent = next((f for f in reversed(stack) if f.mark == "(" and f.call), None)
                lead = TARGET.match(text[start:begin].strip() + " ") if parent is None else None
                receiver, _, name = path.lstrip(".").rpartition(".")
                if name not in SKIPPED:
                    frame.call = {
                        "kind": "call", "pos": begin, "name": name, "is_new": bool(c["new"]), "receiver": receiver or None, "on_call": ended.get(chain), "parent": parent.call["pos"] if parent else None,
                        "parent_arg": len(parent.cuts) - 1 if parent else None, "target": lead["name"].removeprefix("this.") if lead else None, "type": lead["type"] if lead else None, "expression": None, **here,
                    }
            stack.append(frame)
        elif mark in PAIRS:
            while len(stack) > 1 and stack[-1].mark != PAIRS[mark]:
                stack.pop()  # unbalanced: what was open inside never ends
            if len(stack) == 1:
                continue
            done = stack.pop()
            if done.call:
                args = [text[a + 1 : b].strip() for a, b in zip(done.cuts, [*done.cuts[1:], at], strict=True)]
                out.append({**done.call, "until": at, "args": args if args != [""] else []})
                ended[at + 1] = done.call["pos"]
            if mark == "}" and not any(f.mark in ("(", "[") for f in stack):
                start = at + 1
        elif mark == ",":
            if top.mark:
                top.cuts.append(at)
        elif not any(f.mark in ("(", "[") for f in stack):
            out += _statement(text, start, at, here)
            start = at + 1
    return sorted(out, key=lambda r: (r["pos"], r["kind"]))


def _statement(text: str, start: int, end: int, here: dict) -> list[dict]:
    body = text[start:end].strip()
    blank = {"is_new": None, "receiver": None, "on_call": None, "args": None, "parent": None, "parent_arg": None, "until": end, **here}
    row = {"kind": "statement", "pos": start + len(text[start:end]) - len(text[start:end].lstrip()), "name": None, "target": None, "type": None, "expression": body, **blank}
    plain = re.sub(r"^(?:(?:public|private|protected|static|final)\s+)+", "", body)
    if (m := re.match(r"return\b\s*(.*)$", plain, re.S)) is not None:
        return [row | {"name": "return", "expression": m[1]}]
    if (m := TARGET.match(plain)) is not None:
        return [row | {"name": "assign", "target": m["name"].removeprefix("this."), "type": m["type"], "expression": plain[m.end() :].strip()}]
    return [row | {"name": "other"}] if body else []


def read_sources(files: DataFrame, key: str = "file", text: str = "source", settle: bool = True) -> DataFrame:
    """key and the columns of COLUMNS: one row a call or statement; a null text has none.

    The relation is written once, as what is declared is read out of it by
    several joins; unless settle, each of them reads the sources again.
    """

    rel = each_source(files, key, text, relations, COLUMNS)
    return settled(rel, "relation") if settle else rel


def pieces(batches: Iterable[pa.RecordBatch], read: Callable[[str], Iterable[dict]], columns: str) -> Iterator[pa.RecordBatch]:
    """Batches of a key and a text to batches of the key and the given columns, of ROWS rows at most."""
    fields = [c.split() for c in columns.split(", ")]
    for b in batches:
        keys, texts = b.columns
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], keys.type), *[pa.array([r[f] for _, r in rows], ARROW[t]) for f, t in fields]], names=[b.schema.names[0], *[f for f, _ in fields]])  # noqa: B023, E731
        rows: list[tuple[object, dict]] = []
        for key, source in zip(keys, texts, strict=True):
            if source.is_valid:
                rows += [(key.as_py(), r) for r in read(source.as_py())]
            while len(rows) >= ROWS:
                yield batch(rows[:ROWS])
                rows = rows[ROWS:]
        if rows:
            yield batch(rows)


def each_source(files: DataFrame, key: str, text: str, read: Callable[[str], Iterable[dict]], columns: str) -> DataFrame:
    """key and the given columns: the rows that `read` finds in every text; a null text has none.

    Texts are taken up one at a time and rows handed on ROWS at a time, so what
    a worker holds does not grow with the number of files.
    """
    return files.select(key, text).mapInArrow(lambda batches: pieces(batches, read, columns), f"{key} {dict(files.dtypes)[key]}, {columns}")
