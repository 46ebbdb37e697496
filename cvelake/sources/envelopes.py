"""JSON envelopes ``{..., "<key>": [item, item, ...], ...}`` read as streams.

Spark's text reader opens and decompresses a file wherever Spark can read it and cuts it
at every ``{``, so no row is longer than the text between two braces. A task puts the
pieces of a file together again, one item at a time: what it holds is one unfinished
item and the envelope's few other fields, whatever the size of the file. With the items
it sends one outcome row for each file (well formed or why not, items, declared items),
so reading and checking are the same pass.

Inside an item only the balance of brackets outside of strings is followed, which is
counting; a finished item is checked by the JSON parser. An envelope that ends early,
doesn't parse, or has something else than a list under its key is not ``ok``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvelake.session import ship

SEPARATOR = "{"
#: An item, a string or the rest of an envelope may have so many characters.
MOST_CHARS = 256_000_000
#: Characters of items sent on at once.
BATCH_CHARS = 8_000_000
SCHEMA = (
    "file_path string, source_file string, snapshot_date date, raw_json string, "
    "at_end boolean, reason string, n_records long, declared_records long"
)

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+', re.DOTALL)
_ESCAPED = re.compile(r"\\.", re.DOTALL)
INVALID = "invalid JSON"


class Envelope:
    """Takes the pieces of one file in order and gives its items as they end."""

    def __init__(self, key: str, count_key: str | None = None):
        self.key, self.count_key = key, count_key
        self.depth, self.items, self.closed = 0, 0, False
        self.in_list = self.found = self.bad = self.begun = self.odd = False
        self.held: list[str] = []  # pieces of a string that isn't closed yet
        self.parts: list[str] = []  # the unfinished item
        self.outer: list[str] = []  # all tokens besides the items
        self.size = self.outer_size = 0
        self.name = self.last = None
        self.expects_item = True

    def feed(self, piece: str) -> list[str]:
        """The items that end in this piece."""
        piece = SEPARATOR + piece if self.begun else piece.removeprefix("﻿")
        self.begun = True
        if self.bad:
            return []
        plain = _ESCAPED.sub("", piece) if "\\" in piece else piece
        self.odd ^= bool(plain.count('"') & 1)
        if self.odd or self.held:
            self.held.append(piece)
            if self._grown(len(piece)) or self.odd:
                return []
            piece, self.held = "".join(self.held), []
            plain = _ESCAPED.sub("", piece) if "\\" in piece else piece
        if self.parts:
            outside = "".join(plain.split('"')[::2]) if '"' in plain else plain
            ends = outside.count("}") + outside.count("]")
            if self.depth - ends > 2:  # the item goes on behind this piece
                self.depth += outside.count("{") + outside.count("[") - ends
                self.parts.append(piece)
                self._grown(len(piece))
                return []
        return self._tokens(piece)

    def _grown(self, n: int) -> bool:
        self.size += n
        if self.size > MOST_CHARS:
            self.bad, self.held, self.parts = True, [], []
        return self.bad

    def _tokens(self, piece: str) -> list[str]:
        done, start = [], 0 if self.parts else None
        for m in _TOKEN.finditer(piece):
            token = m.group()
            if self.in_list and (self.depth > 2 or token not in ("]", ",")):
                if self.depth == 2:
                    start = m.start()
                    self.bad |= not self.expects_item
                self.depth += (token in ("{", "[")) - (token in ("}", "]"))
                self.bad |= self.depth < 2
                if self.depth == 2:  # a bracket that closes an item, or a plain value
                    item = "".join(self.parts) + piece[start : m.end()]
                    self.parts, self.size, start = [], self.outer_size, None
                    self.items, self.expects_item = self.items + 1, False
                    self.bad |= not _parses(item)
                    done.append(item)
            elif self.in_list and token == ",":
                self.bad |= self.expects_item
                self.expects_item = True
            else:
                self._outside(token)
            if self.bad:
                return []
        if start is not None:
            self.parts.append(piece[start:])
            self._grown(len(piece) - start)
        return done

    def _outside(self, token: str) -> None:
        """A token of the envelope itself, or the bracket that ends its list."""
        if self.in_list:
            self.in_list = False
            self.bad |= self.expects_item and self.items > 0
        if self.closed or (self.depth == 0 and token != "{"):
            self.bad = True
        if token in ("{", "["):
            if self.depth == 1 and token == "[" and self.name == self.key:
                self.in_list = self.found = True
            self.depth += 1
        elif token in ("}", "]"):
            self.depth -= 1
            self.closed = self.depth == 0
        elif self.depth == 1:
            if token == ":" and self.last:
                self.name = json.loads(self.last, strict=False) if _parses(self.last) else None
            self.last = token if token.startswith('"') else None
        self.outer.append(token)
        self.outer_size += len(token)
        self._grown(len(token))

    def end(self) -> tuple[str | None, int | None, int | None]:
        """(what is wrong with the file, its items, the items that it declares)."""
        if self.bad or self.held or not self.closed or not _parses(" ".join(self.outer)):
            return INVALID, None, None
        outer = json.loads(" ".join(self.outer), strict=False)
        declared = outer.get(self.count_key) if self.count_key else None
        declared = declared if type(declared) is int and abs(declared) < 1 << 63 else None
        if not self.found or outer[self.key] != []:
            return f"missing or non-list '{self.key}'", None, declared
        return None, self.items, declared


def _parses(text: str) -> bool:
    try:
        json.loads(text, strict=False)
    except (ValueError, RecursionError):
        return False
    return True


def _scan(key: str, count_key: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file_path", "source_file", "snapshot_date"]
        types = [pa.string(), pa.string(), pa.date32()]
        outcome = ["raw_json", "at_end", "reason", "n_records", "declared_records"]
        outcome_types = [pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int64()]
        file, envelope, rows, size = None, None, [], 0

        def out():
            columns = [list(c) for c in zip(*rows, strict=True)]
            arrays = [pa.array(c, t) for c, t in zip(columns, types + outcome_types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names + outcome)

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in (*names, "value")]
            for *own, piece in zip(*columns, strict=True):
                if file is None or own[0] != file[0]:
                    if file is not None:
                        rows.append((*file, None, True, *envelope.end()))
                    file, envelope = own, Envelope(key, count_key)
                for item in envelope.feed(piece):
                    rows.append((*file, item, False, None, None, None))
                    size += len(item)
                if size > BATCH_CHARS:
                    yield out()
                    rows, size = [], 0
        if file is not None:
            rows.append((*file, None, True, *envelope.end()))
        if rows:
            yield out()

    return run


def scan(pieces: DataFrame, key: str, count_key: str | None = None, in_order: bool = False) -> DataFrame:
    """Item rows and one outcome row (``at_end``) for each file of ``pieces``
    (file_path, source_file, snapshot_date, block, value), as SCHEMA.

    ``in_order``: a task reads a file as a whole and in order, as it does where files
    are compressed as one stream; otherwise a large file is read in several tasks and
    its pieces are first brought together."""
    ship(pieces.sparkSession)
    if not in_order:
        pieces = pieces.withColumn("at", F.monotonically_increasing_id())
        pieces = pieces.repartition("file_path").sortWithinPartitions("file_path", "block", "at")
    return pieces.select("file_path", "source_file", "snapshot_date", "value").mapInArrow(_scan(key, count_key), SCHEMA)
