"""Viewing-history exports as a Python data source that splits large files and streams archives.

A loose export is cut into byte ranges, each a task's; a range yields the array elements or cells that begin in it.
Where a range of a JSON file begins, it is not plain whether inside a string, or how deep. So each range first tells how
it changes both, for either way it may begin, and these facts, a row for each range, chain to the state that every range
begins in. Members of archives are read from the open file, unpacked as they come: neither archive nor member is ever
held whole. An export that is empty, broken, cut off or no array of objects stops the query.
"""

from __future__ import annotations

import json
import re
import tarfile
import zipfile
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import importable
from .openers import BLOCK, blocks, listed, opened

# Members of archives, and kinds of archive.
JSON, HTML = ".json", ".html"
LEAVES = (f"/watch-history{JSON}", f"/watch-history{HTML}")
ARCHIVES = (".zip", ".tgz", ".tar.gz")
#: Bytes of a range.
RANGE = 64 << 20
#: Tasks for each core that ranges of fewer bytes are dealt to.
TASKS = 4
#: Bits of an input place, of which a file's number and a place in the file have their share.
PLACE_BITS, LEAST_BITS = 52, 32

#: The start of a cell in any case; letters that fold to i and s count, as they do in text.
_CELL = re.compile(rb'<d(?:i|\xc4[\xb0\xb1])v cla(?:s|\xc5\xbf)(?:s|\xc5\xbf)="outer-cell', re.I)
_CELL_BYTES = 32
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*("?)|[{}\[\]]', re.S)
_STRING_END = re.compile(rb'(?:[^"\\]|\\.)*"', re.S)
_ESCAPE = re.compile(rb"\\.", re.S)
_decode = json.JSONDecoder(strict=False).raw_decode


class Broken(ValueError):
    pass


def cells(blocks: Iterable[bytes], start: int = 0, end: int | None = None) -> Iterator[tuple[int, bytes]]:
    """Place and text of the cells that begin at start or later and before end; blocks are the bytes from start on."""
    buffer, base, scan, cell = b"", start, 0, None
    for block in blocks:
        buffer += block
        while m := _CELL.search(buffer, scan):
            if cell is not None:
                yield base + cell, buffer[cell : m.start()]
            if end is not None and base + m.start() >= end:
                return
            cell = scan = m.end()
        scan = max(scan, len(buffer) - _CELL_BYTES)
        if cell is None and end is not None and base + scan >= end:
            return
        keep = scan if cell is None else cell
        buffer, base, scan = buffer[keep:], base + keep, scan - keep
        cell = None if cell is None else 0
    if cell is not None:
        yield base + cell, buffer[cell:]


def elements(blocks: Iterable[bytes], start: int = 0, end: int | None = None, depth: int = 0, inside: bool = False, escaped: bool = False) -> Iterator[tuple[int, bytes]]:
    """Place and text of the objects of a JSON array that begin at start or later and before end.

    depth, inside a string, and after a backslash are how the bytes from start on begin.
    """
    more = iter(blocks)
    buffer, base, text = b"", start, None

    def filled() -> bool:
        nonlocal buffer, text
        block = next(more, None)
        if block is None:
            return False
        buffer, text = buffer + block, None
        return True

    filled()
    at = 0
    if start == 0 and buffer.startswith(b"\xef\xbb\xbf"):
        at = 3
    if inside:
        while True:
            if m := _STRING_END.match(buffer, 1 if escaped else 0):
                at = m.end()
                break
            if not filled():
                raise Broken("an export ends inside a string")
    between = at if depth <= 1 else None  # where what stands between two elements begins; None inside an element
    began = None
    first, closed = depth == 0, False
    separators = (b"", b",") if depth == 1 else (b",",)  # the range before has seen what stands before its end
    while True:
        m = _TOKEN.search(buffer, at)
        if m and m[0][:1] == b'"' and not m[1]:  # the string goes on in the next block
            if not filled():
                raise Broken("an export ends inside a string")
            continue
        if m is None:
            at = len(buffer)
            keep = between if began is None and between is not None else began if began is not None else at
            buffer, base, at, text = buffer[keep:], base + keep, at - keep, None
            between = None if between is None else 0
            began = None if began is None else 0
            if not filled():
                break
            continue
        at, token = m.end(), m[0][:1]
        if depth <= 1:
            loose = buffer[between : m.start()].strip(b" \t\r\n")
            if closed or (depth == 0 and (token != b"[" or loose or not first)):
                raise Broken("an export is no JSON array")
            if depth == 0:
                depth, between, first = 1, at, True
                continue
            if token == b"]":
                if loose:
                    raise Broken("an export's array ends badly")
                depth, closed, between = 0, True, at
                continue
            if token != b"{" or loose not in ((b"",) if first else separators):
                raise Broken("an export is no JSON array of objects")
            if end is not None and base + m.start() >= end:
                return
            first, separators = False, (b",",)
            if text is None:
                text = buffer.decode("latin-1")  # a character a byte
            try:  # an object that ends in the buffer
                end_of = _decode(text, m.start())[1]
            except (ValueError, RecursionError):  # token by token
                began, between, depth = m.start(), None, 2
                continue
            yield base + m.start(), buffer[m.start() : end_of]
            at = between = end_of
        elif token in b"{[":
            depth += 1
        elif token in b"}]":
            depth -= 1
            if depth == 1:
                if began is not None:
                    yield base + began, buffer[began:at]
                began, between = None, at  # what was read goes when the next block comes
    if depth or not closed or (between is not None and buffer[between:].strip(b" \t\r\n")):
        raise Broken("an export is cut off")


def changes(blocks: Iterable[bytes], escaped: bool) -> tuple[int, int, int]:
    """Quotes (mod 2) of a range, and how its depth changes if it begins outside a string, and if inside."""
    quotes, deeper, rest = 0, [0, 0], b"\\" if escaped else b""
    for block in blocks:
        block = rest + block
        tail = len(block) - len(block.rstrip(b"\\"))
        rest = b"\\" if tail % 2 else b""
        block = _ESCAPE.sub(b"", block[: len(block) - len(rest)])
        parts = block.split(b'"')
        for way in (0, 1):
            text = b"".join(parts[(quotes + way) % 2 :: 2])
            deeper[way] += sum(text.count(c) for c in (b"{", b"[")) - sum(text.count(c) for c in (b"}", b"]"))
        quotes = (quotes + len(parts) - 1) % 2
    return quotes, deeper[0], deeper[1]


def _escaped(file, start: int) -> bool:
    """Whether the byte at start follows a backslash that counts."""
    n, at = 0, start
    while at:
        size = min(at, 4096)
        file.seek(at - size)
        before = file.read(size)
        run = len(before) - len(before.rstrip(b"\\"))
        n, at = n + run, at - size
        if run < size:
            break
    return n % 2 == 1


def _limited(file, start: int, end: int) -> Iterator[bytes]:
    file.seek(start)
    while start < end and (block := file.read(min(BLOCK, end - start))):
        start += len(block)
        yield block


def member(uri: str) -> tuple[str, Iterator[bytes]]:
    """The history in an archive as it is unpacked: the first JSON member, else the first HTML one."""

    def chosen(names: list[str]) -> str:
        found = next((n for leaf in LEAVES for n in names if n.endswith(leaf)), None)
        if found is None:
            raise Broken(f"{uri} holds no watch-history.json or .html")
        return found

    def unpacked(name: str) -> Iterator[bytes]:
        with opened(uri) as f:
            if uri.endswith(".zip"):
                with zipfile.ZipFile(f) as z, z.open(name) as m:
                    yield from blocks(m)
            else:
                with tarfile.open(fileobj=f, mode="r|gz") as t:
                    for info in t:
                        if info.name == name:
                            yield from blocks(t.extractfile(info))
                            return

    with opened(uri) as f:
        if uri.endswith(".zip"):
            with zipfile.ZipFile(f) as z:
                names = z.namelist()
        else:
            with tarfile.open(fileobj=f, mode="r|gz") as t:
                names = [info.name for info in t]
    name = chosen(names)
    return name, unpacked(name)


class Range(NamedTuple):
    uri: str
    number: int
    size: int
    start: int
    end: int
    depth: int = 0
    inside: bool = False


class Lot(InputPartition):
    """Ranges that a task reads in turn."""

    def __init__(self, ranges: list[Range]):
        self.ranges = ranges


def _packed(ranges: Iterable[Range]) -> str:
    """Ranges as JSON, the address of a file once."""
    return json.dumps([(*file, [r[3:] for r in own]) for file, own in groupby(ranges, lambda r: r[:3])])


def _lots(ranges: Iterable[Range], lot_bytes: int) -> list[list[Range]]:
    """Neighbouring ranges together, until they have so many bytes."""
    lots, left = [], 0
    for r in ranges:
        if left <= 0:
            lots.append([])
            left = lot_bytes
        lots[-1].append(r)
        left -= max(r.end - r.start, 1)
    return lots


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.packed, self.lot_bytes = options["ranges"], int(options["lot_bytes"])
        self.kind = options.get("kind", "")
        self.facts, self.bits = options.get("facts") == "true", int(options.get("bits", LEAST_BITS))

    def __getstate__(self):
        """What tasks get: each has its own ranges, none the list of all."""
        return self.__dict__ | {"packed": ""}

    def partitions(self):
        ranges = (Range(*file, *r) for *file, own in json.loads(self.packed) for r in own)
        return [Lot(own) for own in _lots(ranges, self.lot_bytes)]

    def read(self, part):
        if part is None:  # there are no ranges
            return
        for uri, own in groupby(part.ranges, lambda r: r.uri):
            if uri.endswith(ARCHIVES) and not self.facts:
                for r in own:
                    name, unpacked = member(uri)
                    if name.endswith(self.kind):
                        for i, (_, text) in enumerate((cells if self.kind == HTML else elements)(unpacked)):
                            yield uri, (r.number << self.bits) + i, text.decode("utf-8", "replace")
                continue
            with opened(uri) as f:
                for r in own:
                    yield from self._range(f, r)

    def _range(self, f, r: Range):
        if self.facts:
            yield r.uri, r.start, json.dumps(changes(_limited(f, r.start, r.end), _escaped(f, r.start)))
            return
        escaped = r.inside and _escaped(f, r.start)
        from_here = _limited(f, r.start, r.size)
        found = cells(from_here, r.start, r.end) if self.kind == HTML else elements(from_here, r.start, r.end, r.depth, r.inside, escaped)
        for at, text in found:
            yield r.uri, (r.number << self.bits) + at, text.decode("utf-8", "replace")


class WatchExport(DataSource):
    """Options: ranges (JSON), lot_bytes (of ranges that one task reads), kind (.json or .html), bits of a place in a file, facts (a row of facts for each range in place of its items)."""

    @classmethod
    def name(cls):
        return "watch_export"

    def schema(self):
        return "path string, ingest_ord long, text string"

    def reader(self, schema):
        return _Reader(self.options)


def items(spark: SparkSession, path: str, range_bytes: int = RANGE) -> dict[str, DataFrame]:
    """By kind (JSON, HTML): path, ingest_ord, text of every array element, or cell, of the exports at a path or pattern."""
    importable(spark).dataSource.register(WatchExport)
    files = listed(spark, path)
    if empty := [uri for uri, size in files if not size]:
        raise Broken(f"{empty[0]} is empty")
    bits = max(LEAST_BITS, max((size.bit_length() for _, size in files), default=0))
    if len(files).bit_length() + bits > PLACE_BITS:
        raise ValueError(f"{len(files)} exports of up to 2^{bits} bytes are too many for one read: read them in lots")
    ranges: dict[str, list] = {JSON: [], HTML: []}
    large = []
    for number, (uri, size) in enumerate(files):
        cuts = [0, size] if uri.endswith(ARCHIVES) else [*range(0, size, range_bytes), size]
        own = [Range(uri, number, size, a, b) for a, b in zip(cuts, cuts[1:])]
        if uri.endswith(ARCHIVES):  # of either kind: the reader of the other one looks at its names alone
            ranges[JSON] += own
            ranges[HTML] += own
        elif uri.endswith(HTML):
            ranges[HTML] += own
        elif len(own) > 1:
            large.append(own)
        else:
            ranges[JSON] += own
    if large:
        ranges[JSON] += _begun(spark, large)
    return {k: _read(spark, own, kind=k, bits=bits) for k, own in ranges.items() if own or k == JSON}


def _read(spark: SparkSession, ranges: list[Range], **options) -> DataFrame:
    """Small ranges share tasks, so that there are few for each core; those of RANGE bytes have tasks of their own."""
    lot_bytes = min(RANGE, -(-sum(r.end - r.start for r in ranges) // (TASKS * spark.sparkContext.defaultParallelism)))
    return spark.read.format("watch_export").options(ranges=_packed(ranges), lot_bytes=lot_bytes, **options).load()


def _begun(spark: SparkSession, files: list[list[Range]]) -> list[Range]:
    """The ranges of JSON files with the depth that each begins at, and whether it begins in a string."""
    told = _read(spark, [r for own in files for r in own], facts="true")
    facts = {(r.path, r.ingest_ord): r.text for r in told.collect()}  # a row for each range
    out = []
    for own in files:
        depth, inside = 0, False
        for r in own:
            out.append(r._replace(depth=depth, inside=inside))
            quotes, outside_first, inside_first = json.loads(facts[r.uri, r.start])
            depth, inside = depth + (inside_first if inside else outside_first), inside != bool(quotes)
        if depth or inside:
            raise Broken(f"{own[0].uri} is cut off")
    return out
