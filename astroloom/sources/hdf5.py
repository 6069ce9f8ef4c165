"""HDF5 files of cutouts as rows: one row for each entry of the datasets' first side.

Only byte ranges are read: a task takes some rows of a file, and of these only the datasets that the schema names, so that a schema without
images skips them. Parsed are the structures of the public file format that such files use: superblocks 0 to 3, object headers 1 and 2, groups
by symbol table, by link messages and by a fractal heap of one block, contiguous, compact and chunked layouts (B-trees 1 and 2,
single chunks, fixed and extensible arrays), deflate and shuffle, whole numbers, floats, strings of fixed and of variable length.

Defined results: `tile` with one side only holds for all rows of its file; other datasets that are shorter than the longest are null beyond
their end; a dataset that a file lacks is null; chunks that were never written are zero; files without rows give none. Structures beyond
those named raise ValueError."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .stores import Ranges, listed

MAGIC = b"\x89HDF\r\n\x1a\n"
#: Bytes of a file that one task takes, about, and rows in one Arrow batch.
SPLIT_BYTES, BATCH_ROWS = 64_000_000, 64
#: The format's message types that are used here.
SPACE, LINK_INFO, TYPE, LINK, LAYOUT, FILTERS, CONTINUED, SYMBOLS = 1, 2, 3, 6, 8, 11, 16, 17


def _number(raw: bytes) -> int:
    return int.from_bytes(raw, "little")


class _Cursor:
    def __init__(self, raw: bytes, offsets: int = 8, lengths: int = 8):
        self.raw, self.at, self.offsets, self.lengths = raw, 0, offsets, lengths

    def take(self, n: int) -> bytes:
        self.at += n
        if self.at > len(self.raw):
            raise ValueError("a structure of the file ends early")
        return self.raw[self.at - n : self.at]

    def n(self, size: int) -> int:
        return _number(self.take(size))

    def offset(self) -> int:
        return self.n(self.offsets)

    def length(self) -> int:
        return self.n(self.lengths)

    def sign(self, what: bytes) -> None:
        if (got := self.take(4)) != what:
            raise ValueError(f"expected {what!r} in the file, found {got!r}")


class File:
    """The datasets of a file's root group, by name."""

    def __init__(self, source: Ranges):
        self.source, self.O, self.L, self._heaps = source, 8, 8, {}
        start = next((b for b in (0, 512, 1024, 2048) if source.upto(b, 8) == MAGIC), None)
        if start is None:
            raise ValueError("not an HDF5 file")
        self.base = start
        c = _Cursor(source.upto(start + 8, 120))
        version = c.n(1)
        if version < 2:
            c.take(4)
            self.O, self.L = c.n(1), c.n(1)
            c.take(1 + 4 + 4 + (4 if version == 1 else 0))
            c.offsets = self.O
            c.take(4 * self.O + self.O)
            self.root = c.offset()
        elif version < 4:
            self.O, self.L = c.n(1), c.n(1)
            c.take(1)
            c.offsets = self.O
            c.take(3 * self.O)
            self.root = c.offset()
        else:
            raise ValueError(f"superblocks of version {version} aren't read")
        self.none = (1 << 8 * self.O) - 1
        self.links = dict(self._links())

    def at(self, address: int, n: int, whole: bool = True) -> _Cursor:
        read = self.source.read if whole else self.source.upto
        return _Cursor(read(self.base + address, n), self.O, self.L)

    # ---- object headers ----

    def messages(self, address: int) -> list[tuple[int, bytes]]:
        first = self.at(address, 16, False)
        if first.raw[:4] == b"OHDR":
            c = self.at(address, 34, False)
            c.take(5)
            flags = c.n(1)
            c.take(16 * (flags >> 5 & 1) + 4 * (flags >> 4 & 1))
            size = c.n(1 << (flags & 3))
            blocks, kind = [self.at(address + c.at, size).raw], 2
        else:
            if first.n(1) != 1:
                raise ValueError("an object header of an unknown version")
            first.take(7)
            blocks, kind, flags = [self.at(address + 16, first.n(4)).raw], 1, 0
        out = []
        for block in blocks:  # grows by continuations
            c = _Cursor(block, self.O, self.L)
            head = 8 if kind == 1 else 4 + 2 * (flags >> 2 & 1)
            while len(block) - c.at >= head:
                if kind == 1:
                    what, size = c.n(2), c.n(2)
                    c.take(4)
                else:
                    what, size = c.n(1), c.n(2)
                    c.take(head - 3)
                body = c.take(size)
                if what == CONTINUED:
                    more = _Cursor(body, self.O, self.L)
                    there, n = more.offset(), more.length()
                    blocks.append(self.at(there, n).raw if kind == 1 else self.at(there + 4, n - 8).raw)
                out.append((what, body))
        return out

    # ---- groups ----

    def _links(self) -> Iterator[tuple[str, int]]:
        for what, body in self.messages(self.root):
            c = _Cursor(body, self.O, self.L)
            if what == LINK:
                yield from self._link(c)
            elif what == SYMBOLS:
                tree, heap = c.offset(), c.offset()
                h = self.at(heap, 8 + 2 * self.L + self.O)
                h.sign(b"HEAP")
                h.take(4)
                size = h.length()
                h.length()
                names = self.at(h.offset(), size).raw
                for node in self._leaves(tree):
                    s = self.at(node, 8)
                    s.sign(b"SNOD")
                    s.take(2)
                    entries = self.at(node + 8, s.n(2) * (2 * self.O + 24))
                    while entries.at < len(entries.raw):
                        name, header = entries.offset(), entries.offset()
                        entries.take(24)
                        yield names[name : names.index(b"\0", name)].decode(), header
            elif what == LINK_INFO:
                c.take(1)
                flags = c.n(1)
                c.take(8 * (flags & 1))
                heap, index = c.offset(), c.offset()
                if heap != self.none:
                    yield from self._dense(heap, index)

    def _link(self, c: _Cursor) -> Iterator[tuple[str, int]]:
        c.take(1)
        flags = c.n(1)
        kind = c.n(1) if flags & 8 else 0
        c.take(8 * (flags >> 2 & 1) + (flags >> 4 & 1))
        name = c.take(c.n(1 << (flags & 3))).decode()
        if kind == 0:  # hard links only
            yield name, c.offset()

    def _leaves(self, address: int) -> Iterator[int]:
        """Addresses below a group's B-tree of version 1."""
        c = self.at(address, 8 + 2 * self.O)
        c.sign(b"TREE")
        c.take(1)
        level, used = c.n(1), c.n(2)
        body = self.at(address + 8 + 2 * self.O, used * (self.L + self.O) + self.L)
        for _ in range(used):
            body.length()
            child = body.offset()
            yield from self._leaves(child) if level else [child]

    def _dense(self, heap: int, index: int) -> Iterator[tuple[str, int]]:
        c = self.at(heap, 4 + 1 + 2 + 2 + 1 + 4 + 2 * self.O + 10 * self.L + 2 + 2 * self.L + 4 + self.O + 2)
        c.sign(b"FRHP")
        c.take(3)
        if c.n(2):
            raise ValueError("heaps with filters aren't read")
        c.take(1)
        managed = c.n(4)
        c.take(2 * self.O + 10 * self.L + 2 + self.L)
        direct, bits = c.length(), c.n(2)
        c.take(2)
        root, rows = c.offset(), c.n(2)
        if rows:
            raise ValueError("groups of more than one heap block aren't read")
        size = -(-bits // 8)
        lengths = min((direct.bit_length() + 6) // 8, (managed.bit_length() - 1) // 8 + 1)
        for record in self._records(index):
            own = _Cursor(record[4:], self.O, self.L)
            own.take(1)
            where, n = own.n(size), own.n(lengths)
            yield from self._link(self.at(root + where, n))

    def _records(self, address: int) -> Iterator[bytes]:
        """All records of a B-tree of version 2."""
        c = self.at(address, 4 + 2 + 4 + 2 + 2 + 2 + self.O + 2 + self.L)
        c.sign(b"BTHD")
        c.take(2)
        node, size, depth = c.n(4), c.n(2), c.n(2)
        c.take(2)
        root, used = c.offset(), c.n(2)
        most = [(node - 10) // size]
        total = [most[0]]
        wide = (most[0].bit_length() - 1) // 8 + 1
        sums = [0]
        for d in range(1, depth + 1):
            pointer = self.O + wide + sums[d - 1]
            most.append((node - 10 - pointer) // (size + pointer))
            total.append((most[d] + 1) * total[d - 1] + most[d])
            sums.append((total[d].bit_length() - 1) // 8 + 1)

        def walk(where: int, n: int, d: int) -> Iterator[bytes]:
            b = self.at(where, node)
            b.sign(b"BTIN" if d else b"BTLF")
            b.take(2)
            records = [b.take(size) for _ in range(n)]
            if not d:
                yield from records
                return
            for k in range(n + 1):
                child, own = b.offset(), b.n(wide)
                b.take(sums[d - 1])
                yield from walk(child, own, d - 1)
                yield from records[k : k + 1]

        if root != self.none and used:
            yield from walk(root, used, depth)

    # ---- datasets ----

    def dataset(self, name: str) -> Dataset:
        return Dataset(self, self.messages(self.links[name]))

    def heap_object(self, address: int, index: int) -> bytes:
        """An object of a global heap, which holds strings of variable length."""
        if address not in self._heaps:
            c = self.at(address, 8 + self.L)
            c.sign(b"GCOL")
            c.take(4)
            body, found = self.at(address, c.length()), {}
            body.take(8 + self.L)
            while len(body.raw) - body.at >= 8 + self.L:
                number = body.n(2)
                body.take(6)
                n = body.length()
                if not number:
                    break
                found[number] = body.take(n)
                body.at += -n % 8
            self._heaps[address] = found
        return self._heaps[address][index]


class Dataset:
    """Shape, type and layout of a dataset; rows() reads some entries of its first side."""

    def __init__(self, file: File, messages: list[tuple[int, bytes]]):
        self.file, self.filters = file, []
        for what, body in messages:
            c = _Cursor(body, file.O, file.L)
            if what == SPACE:
                version, sides, flags = c.n(1), c.n(1), c.n(1)
                c.take(5 if version == 1 else 1)
                self.shape = tuple(c.length() for _ in range(sides))
                self.most = tuple(c.length() for _ in range(sides)) if flags & 1 else self.shape
            elif what == TYPE:
                self._type(c)
            elif what == FILTERS:
                self._filters(c)
        layout = next((body for what, body in messages if what == LAYOUT), None)
        if layout is None:
            raise ValueError("a dataset without a layout")
        self._layout(_Cursor(layout, file.O, file.L))

    def _type(self, c: _Cursor) -> None:
        kind, bits, self.size = c.n(1) & 15, c.n(3), c.n(4)
        order = ">" if bits & 1 else "<"
        self.kind = kind
        if kind == 0:
            self.dtype = np.dtype(f"{order}{'i' if bits & 8 else 'u'}{self.size}")
        elif kind == 1:
            self.dtype = np.dtype(f"{order}f{self.size}")
        elif kind == 3 or (kind == 9 and bits & 15 == 1):
            self.dtype = np.dtype(f"V{self.size}")
        else:
            raise ValueError(f"values of class {kind} aren't read")

    def _filters(self, c: _Cursor) -> None:
        version, n = c.n(1), c.n(1)
        c.take(6 if version == 1 else 0)
        for _ in range(n):
            what = c.n(2)
            named = c.n(2) if version == 1 or what >= 256 else 0
            c.take(2)
            values = c.n(2)
            c.take(named + (-named % 8 if version == 1 else 0))
            own = [c.n(4) for _ in range(values)]
            c.take(4 if version == 1 and values % 2 else 0)
            if what not in (1, 2, 3):
                raise ValueError(f"filter {what} isn't read")
            self.filters.append((what, own))

    def _layout(self, c: _Cursor) -> None:
        version, self.layout = c.n(1), c.n(1)
        self.index = None
        if version not in (3, 4):
            raise ValueError(f"layouts of version {version} aren't read")
        if self.layout == 0:
            self.inner = c.take(c.n(2))
        elif self.layout == 1:
            self.address = c.offset()
        elif version == 3:
            sides = c.n(1) - 1
            self.address = c.offset()
            self.chunk = tuple(c.n(4) for _ in range(sides))
            self.index = "tree"
        elif self.layout == 2:
            flags, sides = c.n(1), c.n(1) - 1
            wide = c.n(1)
            self.chunk = tuple(c.n(wide) for _ in range(sides + 1))[:-1]
            self.index = {1: "single", 2: "plain", 3: "fixed", 4: "extensible", 5: "tree2"}[c.n(1)]
            self.alone = (c.length(), c.n(4)) if self.index == "single" and flags & 2 else None
            c.take({"fixed": 1, "extensible": 5, "tree2": 6}.get(self.index, 0))
            self.address = c.offset()
        else:
            raise ValueError("virtual datasets aren't read")

    @property
    def chunk_bytes(self) -> int:
        return int(np.prod(self.chunk, dtype=np.int64)) * self.size

    def chunks(self) -> dict[tuple, tuple[int, int, int]]:
        """Place in the grid of chunks -> address, bytes, filters left out."""
        f, none = self.file, self.file.none
        endless = (1 << 8 * f.L) - 1
        sides = [s if m == endless or self.index in ("tree", "tree2", "single") else m for s, m in zip(self.shape, self.most, strict=True)]
        grid = tuple(-(-s // c) for s, c in zip(sides, self.chunk, strict=True))
        if self.address == none:
            return {}
        if self.index == "tree":
            return {k: v for k, v in self._tree(self.address)}
        if self.index == "single":
            n, mask = self.alone or (self.chunk_bytes, 0)
            return {(0,) * len(grid): (self.address, n, mask)}
        wide = min(8, 1 + ((self.chunk_bytes.bit_length() - 1 + 8) // 8))
        if self.index == "tree2":
            out = {}
            for record in f._records(self.address):
                c = _Cursor(record, f.O, f.L)
                address = c.offset()
                n, mask = (c.n(wide), c.n(4)) if self.filters else (self.chunk_bytes, 0)
                out[tuple(c.n(8) for _ in grid)] = (address, n, mask)
            return out
        if self.index == "plain":
            return {p: (self.address + k * self.chunk_bytes, self.chunk_bytes, 0) for k, p in enumerate(np.ndindex(*grid))}
        elements = self._fixed(wide) if self.index == "fixed" else self._extensible(wide, int(np.prod(grid)))
        # Extensible arrays number chunks with the side that may grow first.
        order = [k for k, m in enumerate(self.most) if m == endless][:1] if self.index == "extensible" else []
        order += [k for k in range(len(grid)) if k not in order]
        out = {}
        for k, element in zip(np.ndindex(*(grid[i] for i in order)), elements, strict=False):
            if element[0] != none:
                out[tuple(k[order.index(i)] for i in range(len(grid)))] = element
        return out

    def _element(self, c: _Cursor, wide: int) -> tuple[int, int, int]:
        address = c.offset()
        return (address, c.n(wide), c.n(4)) if self.filters else (address, self.chunk_bytes, 0)

    def _fixed(self, wide: int) -> list:
        f = self.file
        c = f.at(self.address, 8 + f.L + f.O)
        c.sign(b"FAHD")
        c.take(2)
        size, page, n = c.n(1), c.n(1), c.length()
        block = c.offset()
        if block == f.none:
            return []
        if n > 1 << page:
            raise ValueError("paged indexes of chunks aren't read")
        b = f.at(block, 6 + f.O + n * size)
        b.sign(b"FADB")
        b.take(2 + f.O)
        return [self._element(b, wide) for _ in range(n)]

    def _extensible(self, wide: int, need: int) -> list:
        """The index block's own elements, then those of data blocks, which double in size every other super block."""
        f = self.file
        c = f.at(self.address, 12 + 6 * f.L + f.O)
        c.sign(b"EAHD")
        c.take(2)
        size, bits, own, least, pointers, page = (c.n(1) for _ in range(6))
        c.take(6 * f.L)
        block = c.offset()
        if block == f.none:
            return []
        first, direct = 2 * (pointers.bit_length() - 1), 2 * (pointers - 1)
        supers = 1 + bits - (least.bit_length() - 1)
        b = f.at(block, 6 + f.O + own * size + (direct + supers - first) * f.O)
        b.sign(b"EAIB")
        b.take(2 + f.O)
        out = [self._element(b, wide) for _ in range(own)]
        blocks, later = [b.offset() for _ in range(direct)], [b.offset() for _ in range(supers - first)]
        for s in range(supers):
            many, each = 1 << s // 2, least << (s + 1) // 2
            if len(out) >= need:
                break
            if each > 1 << page:
                raise ValueError("paged indexes of chunks aren't read")
            if s < first:
                mine, blocks = blocks[:many], blocks[many:]
            elif later[s - first] == f.none:
                mine = [f.none] * many
            else:
                x = f.at(later[s - first], 6 + f.O + -(-bits // 8) + many * f.O)
                x.sign(b"EASB")
                x.take(2 + f.O + -(-bits // 8))
                mine = [x.offset() for _ in range(many)]
            for address in mine:
                if address == f.none:
                    out += [(f.none, 0, 0)] * each
                    continue
                d = f.at(address, 6 + f.O + -(-bits // 8) + each * size)
                d.sign(b"EADB")
                d.take(2 + f.O + -(-bits // 8))
                out += [self._element(d, wide) for _ in range(each)]
        return out

    def _tree(self, address: int) -> Iterator[tuple]:
        f, sides = self.file, len(self.chunk)
        c = f.at(address, 8 + 2 * f.O)
        c.sign(b"TREE")
        c.take(1)
        level, used = c.n(1), c.n(2)
        key = 8 + 8 * (sides + 1)
        body = f.at(address + 8 + 2 * f.O, used * (key + f.O) + key)
        for _ in range(used):
            n, mask = body.n(4), body.n(4)
            place = tuple(body.n(8) for _ in range(sides + 1))[:-1]
            child = body.offset()
            if level:
                yield from self._tree(child)
            else:
                yield tuple(p // c for p, c in zip(place, self.chunk, strict=True)), (child, n, mask)

    def _decoded(self, raw: bytes, mask: int) -> np.ndarray:
        for k, (what, values) in reversed(list(enumerate(self.filters))):
            if mask >> k & 1:
                continue
            if what == 1:
                raw = zlib.decompress(raw)
            elif what == 2:
                size = values[0] if values else self.size
                n = len(raw) // size
                raw = np.frombuffer(raw[: n * size], np.uint8).reshape(size, n).T.tobytes() + raw[n * size :]
            else:
                raw = raw[:-4]  # a checksum behind the data
        return np.frombuffer(raw, self.dtype).reshape(self.chunk)

    def rows(self, start: int, end: int) -> np.ndarray:
        """Entries start to end of the first side, and no more bytes than their chunks have."""
        end = min(end, self.shape[0])
        shape = (max(0, end - start), *self.shape[1:])
        each = int(np.prod(self.shape[1:], dtype=np.int64)) * self.size
        if self.layout < 2:
            if self.layout == 1 and self.address == self.file.none:
                return np.zeros(shape, self.dtype)
            raw = self.inner[start * each : end * each] if self.layout == 0 else self.file.at(self.address + start * each, shape[0] * each).raw
            return np.frombuffer(raw, self.dtype).reshape(shape)
        out = np.zeros(shape, self.dtype)
        if not hasattr(self, "_chunks"):
            self._chunks = self.chunks()
        for place, (address, n, mask) in self._chunks.items():
            low = tuple(p * c for p, c in zip(place, self.chunk, strict=True))
            a, b = max(start, low[0]), min(end, low[0] + self.chunk[0])
            if a >= b or any(x >= s for x, s in zip(low[1:], self.shape[1:], strict=True)):
                continue
            got = self._decoded(self.file.at(address, n).raw, mask)
            inner = tuple(slice(x, min(x + c, s)) for x, c, s in zip(low[1:], self.chunk[1:], self.shape[1:], strict=True))
            out[(slice(a - start, b - start), *inner)] = got[(slice(a - low[0], b - low[0]), *(slice(0, s.stop - s.start) for s in inner))]
        return out

    def values(self, start: int, end: int) -> list | np.ndarray:
        """rows() in the machine's own form: numbers as an array, strings as a list."""
        got = self.rows(start, end)
        if self.kind == 3:
            return [bytes(v).split(b"\0")[0].decode("utf-8", "replace").rstrip() for v in got.ravel()]
        if self.kind == 9:
            out = []
            for v in got.ravel():
                c = _Cursor(bytes(v), self.file.O, self.file.L)
                n, address, index = c.n(4), c.offset(), c.n(4)
                out.append(self.file.heap_object(address, index)[:n].decode("utf-8", "replace") if n and address else "")
            return out
        return got.astype(got.dtype.newbyteorder("="))


def _sql_type(d: Dataset) -> T.DataType:
    if d.kind in (3, 9):
        return T.StringType()
    base = {"f4": T.FloatType(), "f8": T.DoubleType(), "f2": T.FloatType()}.get(d.dtype.str[1:]) or (T.IntegerType() if d.size < 4 or d.dtype.str[1:] == "i4" else T.LongType())
    return base if len(d.shape) == 1 and d.shape != (2,) else T.ArrayType(base)


class _Part(InputPartition):
    def __init__(self, path: str, part: int, parts: int):
        super().__init__((path, part, parts))
        self.path, self.part, self.parts = path, part, parts


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, options

    def partitions(self):
        split = int(self.options.get("splitbytes", SPLIT_BYTES))
        files = listed(self.options["path"], self.options.get("pathglobfilter", "*.h5"))
        return [_Part(path, k, n) for path, size in files for n in [max(1, -(-size // split))] for k in range(n)]

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:
            return
        want, source = to_arrow_schema(self.schema), Ranges(partition.path)
        file = File(source)
        heads = {name: file.dataset(name) for name in file.links if name in self.schema.names or name in ("images", "ra")}
        total = max((d.shape[0] for name, d in heads.items() if d.shape and not (name == "tile" and len(d.shape) == 1)), default=0)
        low, high = (total * k // partition.parts for k in (partition.part, partition.part + 1))
        for a in range(low, high, BATCH_ROWS):
            b, columns = min(a + BATCH_ROWS, high), []
            for f, field in zip(self.schema.fields, want, strict=True):
                columns.append(_column(heads.get(f.name), f.name, a, b, field.type, pa))
            yield pa.RecordBatch.from_arrays(columns, schema=want)
        source.close()


def _column(d: Dataset | None, name: str, a: int, b: int, kind, pa):
    if d is None:
        return pa.nulls(b - a, kind)
    if name == "tile" and len(d.shape) == 1:
        return pa.array([d.values(0, d.shape[0]).tolist()] * (b - a), kind)
    got = d.values(min(a, d.shape[0]), b)
    if pa.types.is_list(kind):
        each = int(np.prod(d.shape[1:], dtype=np.int64))
        edges = pa.array(np.arange(len(got) + 1, dtype=np.int32) * each)
        out = pa.ListArray.from_arrays(edges, pa.array(np.ascontiguousarray(got).ravel()).cast(kind.value_type)).cast(kind)
    else:
        out = pa.array(got).cast(kind)
    return out if len(out) == b - a else pa.concat_arrays([out, pa.nulls(b - a - len(out), kind)])


class Cutouts(DataSource):
    """spark.read.format("hdf5_cutouts"), with a schema whose names are those of the datasets."""

    @classmethod
    def name(cls) -> str:
        return "hdf5_cutouts"

    def schema(self) -> T.StructType:
        path = listed(self.options["path"], self.options.get("pathglobfilter", "*.h5"))[0][0]
        file = File(Ranges(path))
        return T.StructType([T.StructField(n, _sql_type(file.dataset(n))) for n in sorted(file.links)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, {k.lower(): v for k, v in self.options.items()})


def cutouts(spark: SparkSession, path: str, schema: str | T.StructType | None = None, glob: str = "*.h5", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows of the files under path. schema names the datasets to read; without one it is taken from the first file. Entries with more than one side are flat arrays."""
    spark.dataSource.register(Cutouts)
    reader = spark.read.format("hdf5_cutouts").option("pathGlobFilter", glob).option("splitBytes", split_bytes)
    return (reader.schema(schema) if schema is not None else reader).load(path)
