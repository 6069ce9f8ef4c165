"""Writes small HDF5 files from the public format, as the tests' own inputs: old groups, dense groups, growing datasets."""

from __future__ import annotations

import struct
import zlib

import numpy as np

NONE = b"\xff" * 8
ENDLESS = 2**64 - 1


def q(*n: int) -> bytes:
    return b"".join(struct.pack("<Q", x) for x in n)


class Builder:
    def __init__(self, head: int):
        self.raw = bytearray(head)

    def put(self, data: bytes) -> int:
        self.raw += bytes(-len(self.raw) % 8)
        at = len(self.raw)
        self.raw += data
        return at

    # messages

    def space(self, shape, most=None, version=1) -> bytes:
        head = bytes([version, len(shape), int(most is not None)]) + (bytes(5) if version == 1 else b"\1")
        return head + q(*shape) + (q(*most) if most is not None else b"")

    def type_of(self, a: np.ndarray, text: str = "") -> bytes:
        if text == "grows":
            return bytes([0x19, 1, 0, 0]) + struct.pack("<I", 16) + bytes([0x10, 0, 0, 0]) + struct.pack("<I", 1) + struct.pack("<HH", 0, 8)
        if a.dtype.kind == "S":
            return bytes([0x13, 0, 0, 0]) + struct.pack("<I", a.itemsize)
        big = int(a.dtype.byteorder == ">")
        if a.dtype.kind == "i":
            return bytes([0x10, 8 | big, 0, 0]) + struct.pack("<I", a.itemsize) + struct.pack("<HH", 0, 8 * a.itemsize)
        return bytes([0x11, 0x20 | big, 31, 0]) + struct.pack("<I", a.itemsize) + struct.pack("<HHBBBBI", 0, 32, 23, 8, 0, 23, 127)

    def header1(self, messages) -> int:
        body = b""
        for what, data in messages:
            data += bytes(-len(data) % 8)
            body += struct.pack("<HHB3x", what, len(data), 0) + data
        return self.put(struct.pack("<BxHII4x", 1, len(messages), 1, len(body)) + body)

    def header2(self, messages, continued: int = 0) -> int:
        """The last `continued` messages stand in a block of their own."""
        part = lambda own: b"".join(struct.pack("<BHB", what, len(data), 0) + data for what, data in own)
        own = messages
        if continued:
            more = b"OCHK" + part(messages[-continued:]) + bytes(4)
            own = [*messages[:-continued], (16, q(self.put(more), len(more)))]
        body = part(own)
        return self.put(b"OHDR\2\2" + struct.pack("<I", len(body)) + body + bytes(4))

    # data

    def heap(self, strings) -> bytes:
        """References to strings in a global heap."""
        objects = b"".join(struct.pack("<HH4xQ", k + 1, 1, len(s)) + s + bytes(-len(s) % 8) for k, s in enumerate(strings)) + bytes(16)
        at = self.put(b"GCOL\1\0\0\0" + q(16 + len(objects)) + objects)
        return b"".join(struct.pack("<IQI", len(s), at, k + 1) if s else bytes(16) for k, s in enumerate(strings))

    def pieces(self, a: np.ndarray, chunk, deflate: bool, shuffle: bool = False) -> dict:
        """Place in the grid -> address and bytes of each chunk."""
        out = {}
        for place in np.ndindex(*(-(-s // c) for s, c in zip(a.shape, chunk, strict=True))):
            full = np.zeros(chunk, a.dtype)
            own = a[tuple(slice(p * c, p * c + c) for p, c in zip(place, chunk, strict=True))]
            full[tuple(slice(0, s) for s in own.shape)] = own
            raw = full.tobytes()
            if shuffle:
                raw = np.frombuffer(raw, np.uint8).reshape(-1, a.itemsize).T.tobytes()
            raw = zlib.compress(raw) if deflate else raw
            out[place] = (self.put(raw), len(raw))
        return out

    def tree1(self, chunk, found: dict, size: int, wide: int = 4) -> int:
        """A B-tree of version 1, of two levels where there are more than `wide` chunks."""

        def node(level, rows):
            key = lambda place, n: struct.pack("<II", n, 0) + q(*(p * c for p, c in zip(place, chunk, strict=True)), 0)
            body = b"".join(key(place, n) + q(child) for place, n, child in rows) + key([99] * len(chunk), 0)
            return self.put(b"TREE" + struct.pack("<BBH", 1, level, len(rows)) + NONE + NONE + body)

        rows = [(place, n, at) for place, (at, n) in sorted(found.items())]
        if len(rows) <= wide:
            return node(0, rows)
        return node(1, [(rows[k][0], 0, node(0, rows[k : k + wide])) for k in range(0, len(rows), wide)])

    def tree2(self, kind: int, records: list[bytes], node: int = 256) -> int:
        """A B-tree of version 2: one leaf, or a root over leaves."""
        size = len(records[0])
        most = (node - 10) // size
        leaf = lambda own: self.put((b"BTLF\0" + bytes([kind]) + b"".join(own)).ljust(node, b"\0"))
        if len(records) <= most:
            root, used, depth = leaf(records), len(records), 0
        else:
            parts, between, left = [], [], list(records)
            while left:
                parts.append(left[:most])
                between += left[most : most + 1]
                left = left[most + 1 :]
            if len(parts) == len(between):
                parts[-1], between[-1:] = parts[-1] + between[-1:] if len(parts[-1]) < most else parts[-1], []
            pointers = b"".join(q(leaf(own)) + bytes([len(own)]) for own in parts)
            root, used, depth = self.put((b"BTIN\0" + bytes([kind]) + b"".join(between) + pointers).ljust(node, b"\0")), len(between), 1
        return self.put(b"BTHD\0" + bytes([kind]) + struct.pack("<IHHBB", node, size, depth, 100, 40) + q(root) + struct.pack("<H", used) + q(len(records)) + bytes(4))

    def extensible(self, elements: list[bytes], size: int) -> int:
        """An extensible array of 4 elements in its index block and data blocks from 2 elements on."""
        own, least, pointers, bits = 4, 2, 2, 32
        first, direct, supers = 2, 2, 1 + bits - 1
        head = self.put(bytes(72))
        missing = NONE + bytes(size - 8)
        take = lambda n: [elements.pop(0) if elements else missing for _ in range(n)]
        inner, blocks, later = take(own), [], []
        for s in range(supers):
            mine = []
            for _ in range(1 << s // 2):
                each = least << (s + 1) // 2
                mine.append(self.put(b"EADB\0\0" + q(head) + bytes(4) + b"".join(take(each)) + bytes(4)) if elements else ENDLESS)
            if s < first:
                blocks += mine
            else:
                later.append(self.put(b"EASB\0\0" + q(head) + bytes(4) + q(*mine) + bytes(4)) if mine[0] != ENDLESS else ENDLESS)
        index = self.put(b"EAIB\0\0" + q(head) + b"".join(inner) + q(*blocks, *later) + bytes(4))
        assert len(blocks) == direct
        self.raw[head : head + 72] = b"EAHD\0\0" + bytes([size, bits, own, least, pointers, 10]) + bytes(48) + q(index) + bytes(4)
        return head


def old(columns: dict, chunks: dict) -> bytes:
    """Superblock 0, a symbol table, object headers 1; datasets named in chunks are chunked, deflated and shuffled, the others contiguous."""
    b = Builder(96)
    headers = {}
    for name, a in sorted(columns.items()):
        messages = [(1, b.space(a.shape)), (3, b.type_of(a))]
        if name in chunks:
            tree = b.tree1(chunks[name], b.pieces(a, chunks[name], True, True), a.itemsize)
            messages += [(11, b"\1\2" + bytes(6) + struct.pack("<HHHHII", 2, 0, 1, 1, a.itemsize, 0) + struct.pack("<HHHHII", 1, 0, 1, 1, 4, 0))]
            messages += [(8, bytes([3, 2, a.ndim + 1]) + q(tree) + struct.pack(f"<{a.ndim + 1}I", *chunks[name], a.itemsize))]
        else:
            messages += [(8, b"\3\1" + q(b.put(a.tobytes()), a.nbytes))]
        headers[name] = b.header1(messages)
    names, at = b"\0" * 8, {}
    for name in headers:
        at[name] = len(names)
        names += name.encode() + b"\0"
        names += bytes(-len(names) % 8)
    heap = b.put(b"HEAP" + bytes(4) + q(len(names), 1, b.put(names)))
    node = b.put(b"SNOD\1\0" + struct.pack("<H", len(headers)) + b"".join(q(at[n], h) + bytes(24) for n, h in headers.items()))
    tree = b.put(b"TREE" + struct.pack("<BBH", 0, 0, 1) + NONE + NONE + q(0, node, 8))
    root = b.header1([(17, q(tree, heap))])
    b.raw[:96] = b"\x89HDF\r\n\x1a\n" + bytes([0, 0, 0, 0, 0, 8, 8, 0]) + struct.pack("<HHI", 4, 16, 0) + q(0) + NONE + q(len(b.raw)) + NONE + q(0, root) + bytes(24)
    return bytes(b.raw)


def _latest(b: Builder, root: int) -> bytes:
    b.raw[:48] = b"\x89HDF\r\n\x1a\n" + bytes([3, 8, 8, 0]) + q(0) + NONE + q(len(b.raw), root) + bytes(4)
    return bytes(b.raw)


def _link(name: str, at: int) -> bytes:
    return bytes([1, 0, len(name)]) + name.encode() + q(at)


def dense(columns: dict) -> bytes:
    """Superblock 3, links in a fractal heap with an index, contiguous datasets; lists of strings have variable length."""
    b = Builder(48)
    links = []
    for name, a in columns.items():
        text = "grows" if isinstance(a, list) else ""
        raw, shape = (b.heap([s.encode() for s in a]), (len(a),)) if text else (a.tobytes(), a.shape)
        messages = [(1, b.space(shape, version=2)), (3, b.type_of(None if text else a, text)), (8, b"\4\1" + q(b.put(raw), len(raw)))]
        links.append(_link(name, b.header2(messages, 1)))
    block, ids = b"FHDB\0" + bytes(8 + 4), []
    for link in links:
        ids.append(b"\0" + struct.pack("<IH", len(block), len(link)))
        block += link
    at = b.put(block.ljust(512, b"\0"))
    heap = b"FRHP\0" + struct.pack("<HHBI", 7, 0, 2, 4096) + q(0) + NONE + q(0) + NONE + q(512, 512, 0, len(links), 0, 0, 0, 0)
    heap = b.put(heap + struct.pack("<H", 4) + q(512, 65536) + struct.pack("<HH", 32, 1) + q(at) + struct.pack("<H", 0) + bytes(4))
    index = b.tree2(5, [struct.pack("<I", k) + own for k, own in enumerate(ids)])
    return _latest(b, b.header2([(2, b"\0\0" + q(heap, index))]))


def growing(columns: dict, chunks: dict, deflate: bool = False) -> bytes:
    """Superblock 3, link messages, datasets that grow: an extensible array for one endless side, a B-tree of version 2 for more."""
    b = Builder(48)
    links = []
    for name, a in columns.items():
        text = "grows" if isinstance(a, list) else ""
        if text:
            a = np.frombuffer(b.heap([s.encode() for s in a]), "V16")
        chunk = chunks.get(name, (3, *a.shape[1:]))
        many = name == "images"
        found = b.pieces(a, chunk, deflate)
        element = lambda v: q(v[0]) + (struct.pack("<HI", v[1], 0) if deflate else b"")
        wide = 1 + (int(np.prod(chunk) * a.itemsize).bit_length() - 1 + 8) // 8
        if deflate:
            element = lambda v, w=wide: q(v[0]) + v[1].to_bytes(w, "little") + bytes(4)
        dims = bytes([4, 2, 0, a.ndim + 1, 4]) + struct.pack(f"<{a.ndim + 1}I", *chunk, a.itemsize)
        if many:
            tree = ENDLESS if not found else b.tree2(11 if deflate else 10, [element(v) + q(*place) for place, v in sorted(found.items())])
            layout = dims + bytes([5]) + struct.pack("<IBB", 256, 100, 40) + q(tree)
        else:
            array = b.extensible([element(v) for _, v in sorted(found.items())], 8 + (wide + 4 if deflate else 0))
            layout = dims + bytes([4, 32, 4, 2, 2, 10]) + q(array)
        most = [ENDLESS] * a.ndim if many else [ENDLESS, *a.shape[1:]]
        messages = [(1, b.space(a.shape, most, 2)), (3, b.type_of(a, text)), (8, layout)]
        if deflate:
            messages.insert(2, (11, b"\2\1" + struct.pack("<HHHI", 1, 0, 1, 4)))
        links.append((6, _link(name, b.header2(messages))))
    return _latest(b, b.header2([(2, b"\0\0" + NONE + NONE), *links]))
