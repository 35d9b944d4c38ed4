"""FLAC: lossless 8-bit mono streams, and a decoder that checks what it decodes.

Encoding: blocks of BLOCK samples; each frame is a constant, a linear predictor of order
ORDER with Rice-coded residuals, or verbatim, whichever is shortest.  The seek table
names every frame, so that frames are decoded side by side.

Decoding: numpy steps through the frames of many streams in parallel, one sample of each
at a time: a table gives the length of a Rice code's unary part, the predictor is a dot
product over the last samples.  Frames of other encoders (fixed predictors, partitioned
residuals, escapes, several channels, other depths) take a plain decoder.  CRC-8 of
every header, CRC-16 of every frame and the MD5 of the samples must agree, else the
stream is an error.

Defined results: a null text is an empty one; an empty payload is filled up to 192
spaces; equal texts give equal streams; repeated rows are stored each; only doc_id and
text are read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import shared_dir, written

UNIT, BLOCK, ORDER = 192, 4608, 8
PRECISION, SHIFT, MAX_RICE, LONGEST_RUN = 12, 10, 10, 14
#: Samples that are encoded or decoded together.
ENCODE_AT_ONCE, DECODE_AT_ONCE = 1 << 19, 4 << 20
#: Block sizes with a code of their own in a frame header.
SIZE_CODES = {192: 1} | {576 << i: 2 + i for i in range(4)} | {256 << i: 8 + i for i in range(8)}
CODE_SIZES = {v: k for k, v in SIZE_CODES.items()}


def _crc_table(bits: int, poly: int) -> np.ndarray:
    table, top = [], 1 << bits - 1
    for byte in range(256):
        c = byte << bits - 8
        for _ in range(8):
            c = (c << 1 ^ poly if c & top else c << 1) & (1 << bits) - 1
        table.append(c)
    return np.array(table, np.uint16)


CRC8, CRC16 = _crc_table(8, 0x07), _crc_table(16, 0x8005)
_FAR: list[np.ndarray] = [CRC16]


def _far(n: int) -> np.ndarray:
    """Row d: the CRC-16 of a byte that d zero bytes follow; grown as frames need it."""
    while len(_FAR) < n:
        last = _FAR[-1]
        _FAR.append((last << np.uint16(8)) ^ CRC16[last >> 8])
    return np.array(_FAR[:n]) if n else np.empty((0, 256), np.uint16)


_FAR_ARRAY = np.empty((0, 256), np.uint16)


def crc16s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-16 of data[start:end] for each pair; CRCs are linear, so bytes count by distance."""
    global _FAR_ARRAY
    longest = int((ends - starts).max(initial=0))
    if len(_FAR_ARRAY) < longest:
        _FAR_ARRAY = _far(longest)
    out = np.zeros(len(starts), np.uint16)
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        n = b - a
        out[i] = np.bitwise_xor.reduce(_FAR_ARRAY[np.arange(n - 1, -1, -1), data[a:b]]) if n else 0
    return out


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = int(CRC8[c ^ b])
    return c


def _coded_number(n: int) -> bytes:
    """Frame numbers are coded as in UTF-8, up to 36 bits."""
    if n < 128:
        return bytes([n])
    rest = []
    while n >= 1 << (6 - len(rest)) or not rest:
        rest.insert(0, 0x80 | n & 0x3F)
        n >>= 6
    return bytes([0xFF << 7 - len(rest) & 0xFF | n, *rest]) if len(rest) < 6 else bytes([0xFE, *rest])


def _frame_head(number: int, size: int) -> bytes:
    code = SIZE_CODES.get(size, 7)
    head = bytes([0xFF, 0xF8, code << 4, 0x02]) + _coded_number(number) + (struct.pack(">H", size - 1) if code == 7 else b"")
    return head + bytes([crc8(head)])


def _pack_bits(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bytes of the values (big-endian fields of up to 32 bits) one after the other."""
    keep = lengths > 0
    v, n = values[keep].astype(np.uint64), lengths[keep].astype(np.int64)
    end = np.cumsum(n)
    at = end - n
    total = int(end[-1])
    word = at >> 5
    v <<= (64 - (at & 31) - n).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    both = np.bitwise_or.reduceat(v, first)
    out = np.zeros(total // 32 + 3, np.uint32)
    out[word[first]] |= (both >> np.uint64(32)).astype(np.uint32)
    out[word[first] + 1] |= both.astype(np.uint32)
    return out.astype(">u4").view(np.uint8)[: total // 8]


def _frames(samples: np.ndarray, size: int, numbers: list[int]) -> list[bytes]:
    """Frames of blocks of one size; ``samples`` is (blocks, size) of int8 values."""
    n = len(samples)
    x = samples.astype(np.int32)
    y = x.astype(np.float32)
    r = np.stack([np.einsum("ij,ij->i", y[:, lag:], y[:, : size - lag]) for lag in range(ORDER + 1)], 1).astype(float)
    toeplitz = r[:, np.abs(np.subtract.outer(np.arange(ORDER), np.arange(ORDER)))] + np.eye(ORDER) * (1e-3 * r[:, :1, None] / size + 1e-9)
    limit = (1 << PRECISION - 1) - 1
    coefs = np.clip(np.rint(np.linalg.solve(toeplitz, r[:, 1:, None])[:, :, 0] * (1 << SHIFT)), -limit, limit).astype(np.int32)
    predicted = np.zeros((n, size - ORDER), np.int32)
    for j in range(ORDER):
        predicted += coefs[:, j : j + 1] * x[:, ORDER - 1 - j : size - 1 - j]
    residual = x[:, ORDER:] - (predicted >> SHIFT)
    folded = (residual << 1) ^ (residual >> 31)
    costs = np.stack([(folded >> k).sum(axis=1, dtype=np.int64) + folded.shape[1] * (1 + k) for k in range(MAX_RICE + 1)], 1)
    rice = costs.argmin(axis=1)
    constant = (x == x[:, :1]).all(axis=1)
    predictor = ~constant & (costs.min(axis=1) + ORDER * (8 + PRECISION) + 19 < 8 * size) & ((folded >> rice[:, None]).max(axis=1) <= LONGEST_RUN)

    heads = [_frame_head(i, size) for i in numbers]
    wide = max(map(len, heads))
    head = np.array([list(h.ljust(wide, b"\0")) for h in heads], np.int64)
    head_n = np.where(np.arange(wide) < np.array([[len(h)] for h in heads]), 8, 0)
    kind = np.where(constant, 0, np.where(predictor, 0x40 | (ORDER - 1) << 1, 0x02))[:, None]
    warm = x[:, :ORDER] & 0xFF
    warm_n = np.broadcast_to(np.where(constant[:, None], np.where(np.arange(ORDER) == 0, 8, 0), 8), warm.shape)
    side = np.concatenate([np.full((n, 1), PRECISION - 1), np.full((n, 1), SHIFT), coefs & (1 << PRECISION) - 1, rice[:, None]], 1)
    side_n = np.array([4, 5, *[PRECISION] * ORDER, 10]) * predictor[:, None]
    run = folded >> rice[:, None]
    low = (folded & (1 << rice[:, None]) - 1) | 1 << rice[:, None]
    body = np.where(predictor[:, None], low, x[:, ORDER:] & 0xFF)
    body_n = np.where(predictor[:, None], run + 1 + rice[:, None], np.where(constant[:, None], 0, 8))
    values = np.concatenate([head, kind, warm, side, body], 1)
    lengths = np.concatenate([head_n, np.full((n, 1), 8), warm_n, side_n, body_n], 1)
    bits = lengths.sum(axis=1)
    fill = -bits % 8
    values = np.concatenate([values, np.zeros((n, 2), np.int64)], 1).reshape(-1)
    lengths = np.concatenate([lengths, fill[:, None], np.full((n, 1), 16)], 1).reshape(-1)
    data = _pack_bits(values, lengths)
    ends = np.cumsum((bits + fill) // 8 + 2)
    starts = ends - (bits + fill) // 8 - 2
    sums = crc16s(data, starts, ends - 2)
    data = data.copy()
    data[ends - 2], data[ends - 1] = sums >> 8, sums & 0xFF
    return [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _stream(samples: np.ndarray, frames: list[bytes]) -> bytes:
    sizes = [len(f) for f in frames]
    info = struct.pack(">HH", BLOCK, BLOCK) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
    info += (8000 << 44 | 7 << 36 | len(samples)).to_bytes(8, "big") + hashlib.md5(samples.tobytes()).digest()
    blocks = [(0, info)]
    if len(frames) > 1:
        at, points = 0, b""
        for i, n in enumerate(sizes):
            points += struct.pack(">QQH", i * BLOCK, at, min(BLOCK, len(samples) - i * BLOCK))
            at += n
        blocks.append((3, points))
    out = [b"fLaC"]
    for i, (kind, data) in enumerate(blocks):
        out.append(bytes([kind | 0x80 * (i == len(blocks) - 1)]) + len(data).to_bytes(3, "big") + data)
    return b"".join(out + frames)


def payload_of(text: str | None) -> bytes:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b" " * (UNIT - len(data) if len(data) <= UNIT else -len(data) % UNIT)


def encode_streams(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload, whose bytes less 128 are its samples."""
    samples = [(np.frombuffer(p, np.uint8) ^ 0x80).view(np.int8) for p in payloads]
    blocks: dict[int, list[tuple[int, int]]] = {}
    for i, s in enumerate(samples):
        for k in range(0, len(s), BLOCK):
            blocks.setdefault(min(BLOCK, len(s) - k), []).append((i, k))
    frames: list[dict[int, bytes]] = [{} for _ in payloads]
    for size, own in blocks.items():
        each = max(1, ENCODE_AT_ONCE // size)
        for j in range(0, len(own), each):
            some = own[j : j + each]
            done = _frames(np.stack([samples[i][k : k + size] for i, k in some]), size, [k // BLOCK for _, k in some])
            for (i, k), f in zip(some, done, strict=True):
                frames[i][k] = f
    return [_stream(s, [f[k] for k in sorted(f)]) for s, f in zip(samples, frames, strict=True)]


def metadata(data: bytes) -> dict:
    """What a stream's metadata says, and where its frames begin."""
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, out, last = 4, {"points": []}, False
    while not last:
        last, kind, n = data[at] >> 7, data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        body = data[at + 4 : at + 4 + n]
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            out |= {"rate": packed >> 44, "channels": (packed >> 41 & 7) + 1, "depth": (packed >> 36 & 31) + 1, "samples": packed & (1 << 36) - 1, "md5": body[18:34], "block": int.from_bytes(body[2:4], "big")}
        elif kind == 3:
            out["points"] = [p for p in struct.iter_unpack(">QQH", body) if p[0] < 1 << 63]
        at += 4 + n
    return out | {"at": at}


def read_head(data: bytes, at: int) -> tuple[int, int, int, int, int]:
    """(number, block size, channel code, depth code, where the subframes begin) of a frame."""
    if data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8:
        raise ValueError("no frame begins here")
    code, rate = data[at + 2] >> 4, data[at + 2] & 15
    p, first = at + 4, data[at + 4]
    more = 0 if first < 0x80 else 8 - (~first & 0xFF).bit_length() - 1
    number = first if not more else first & (1 << max(0, 6 - more)) - 1
    for b in data[p + 1 : p + 1 + more]:
        number = number << 6 | b & 0x3F
    p += 1 + more
    if code in (6, 7):
        n = code - 5
        size = int.from_bytes(data[p : p + n], "big") + 1
        p += n
    else:
        size = CODE_SIZES[code]
    p += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if crc8(data[at:p]) != data[p]:
        raise ValueError("a frame header's CRC-8 is wrong")
    return number, size, data[at + 3] >> 4, data[at + 3] >> 1 & 7, p + 1


class _Bits:
    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at * 8

    def take(self, n: int) -> int:
        first, last = self.at >> 3, self.at + n + 7 >> 3
        self.at += n
        return int.from_bytes(self.data[first:last], "big") >> (last * 8 - self.at) & (1 << n) - 1 if n else 0

    def signed(self, n: int) -> int:
        v = self.take(n)
        return v - (1 << n) if n and v >> n - 1 else v

    def zeros(self) -> int:
        n = 0
        while not self.take(1):
            n += 1
        return n


def _residuals(bits: _Bits, size: int, order: int) -> list[int]:
    width, escape = ((4, 15), (5, 31))[bits.take(2)]
    parts = 1 << bits.take(4)
    out: list[int] = []
    for i in range(parts):
        rice, n = bits.take(width), size // parts - order * (i == 0)
        if rice == escape:
            depth = bits.take(5)
            out += [bits.signed(depth) for _ in range(n)]
        else:
            for _ in range(n):
                v = bits.zeros() << rice | bits.take(rice)
                out.append(v >> 1 ^ -(v & 1))
    return out


def _subframe(bits: _Bits, size: int, depth: int) -> list[int]:
    bits.take(1)
    kind, wasted = bits.take(6), 0
    if bits.take(1):
        wasted = bits.zeros() + 1
    depth -= wasted
    if kind == 0:
        x = [bits.signed(depth)] * size
    elif kind == 1:
        x = [bits.signed(depth) for _ in range(size)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 8 if kind < 32 else kind - 31
        x = [bits.signed(depth) for _ in range(order)]
        shift, coefs = 0, [(), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1)][order] if kind < 32 else ()
        if kind >= 32:
            precision, shift = bits.take(4) + 1, bits.signed(5)
            coefs = [bits.signed(precision) for _ in range(order)]
        for r in _residuals(bits, size, order):
            x.append(r + (sum(c * v for c, v in zip(coefs, reversed(x), strict=False)) >> shift))
    else:
        raise ValueError("reserved kind of subframe")
    return [v << wasted for v in x] if wasted else x


def decode_frame(data: bytes, at: int, depth: int) -> tuple[list[list[int]], int]:
    """(channels, where the frame ends) of any frame; its CRC-16 must agree."""
    _, size, code, kind, p = read_head(data, at)
    depth = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}.get(kind, depth)
    bits = _Bits(data, p)
    wide = {8: (0, 1), 9: (1, 0), 10: (0, 1)}.get(code, (0,) * (code + 1))
    x = [_subframe(bits, size, depth + w) for w in wide]
    end = bits.at + 7 >> 3
    if int(crc16s(np.frombuffer(data, np.uint8), np.array([at]), np.array([end]))[0]) != int.from_bytes(data[end : end + 2], "big"):
        raise ValueError("a frame's CRC-16 is wrong")
    if code == 8:
        x[1] = [a - b for a, b in zip(*x, strict=True)]
    elif code == 9:
        x[0] = [a + b for a, b in zip(*x, strict=True)]
    elif code == 10:
        x = [[((a << 1 | b & 1) + b) >> 1 for a, b in zip(*x, strict=True)], [((a << 1 | b & 1) - b) >> 1 for a, b in zip(*x, strict=True)]]
    return x, end + 2


RUN = np.array([16 - int(v).bit_length() for v in range(1 << 16)], np.uint8)


def _lanes(data: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frames with a predictor of order ORDER and one Rice partition, side by side.

    ``at``: where the frames' warm-up samples begin; ``sizes`` descend.  Gives samples by
    (place, frame), and the bit after each frame's last sample.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
    window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]

    def field(pos, n):
        return (window[pos >> 3] << (pos & 7).astype(np.uint32)) >> np.uint32(32 - n)

    x = np.zeros((int(sizes[0]), len(at)), np.int32)
    for i in range(ORDER):
        x[i] = data[at + i].view(np.int8)
    pos = (at + ORDER) * 8 + 9
    coefs = np.empty((ORDER, len(at)), np.int32)
    for j in range(ORDER):
        coefs[ORDER - 1 - j] = (field(pos, PRECISION).astype(np.int32) << 32 - PRECISION) >> 32 - PRECISION
        pos = pos + PRECISION
    rice = field(pos + 6, 4).astype(np.uint32)
    pos = pos + 10
    live = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left")
    for i in range(ORDER, int(sizes[0])):
        m = int(live[i])
        p, k = pos[:m], rice[:m]
        w = window[p >> 3] << (p & 7).astype(np.uint32)
        q = RUN[w >> 16].astype(np.uint32)
        w <<= q + np.uint32(1)
        # k low bits after the stop bit; in two shifts, as k may be 0
        v = q << k | (w >> 1) >> (np.uint32(31) - k)
        r = (v >> 1).astype(np.int32) ^ -(v & 1).astype(np.int32)
        x[i, :m] = r + ((x[i - ORDER : i, :m] * coefs[:, :m]).sum(axis=0) >> SHIFT)
        pos[:m] += q.astype(np.int64) + 1 + k
    return x, pos


def _own_profile(data: bytes, p: int) -> bool:
    """Whether the frame whose subframe begins at p can be decoded by ``_lanes``."""
    bits = _Bits(data, p)
    if bits.take(8) != 0x40 | (ORDER - 1) << 1:
        return False
    bits.at += 8 * ORDER
    if bits.take(4) != PRECISION - 1 or bits.take(5) != SHIFT:
        return False
    bits.at += PRECISION * ORDER
    return bits.take(6) == 0 and bits.take(4) <= MAX_RICE


def decode_streams(streams: list[bytes]) -> list[tuple[dict, list[tuple[int, bytes]]]]:
    """(metadata, [(first sample, PCM bytes)]) of each 8-bit mono stream, checked."""
    plans, lanes, base = [], [], 0
    for s in streams:
        m = metadata(s)
        frames, offset, first = {}, m["at"], 0
        if m["channels"] != 1 or m["depth"] != 8:
            raise ValueError("8-bit mono is expected here; decode_frame takes others")
        points = m["points"] or ([(0, 0, m["samples"])] if 0 < m["samples"] <= BLOCK else [])
        if points and sum(p[2] for p in points) == m["samples"]:
            ends = [m["at"] + p[1] for p in points[1:]] + [len(s)]
            for (first, at, _), end in zip(points, ends, strict=True):
                at += m["at"]
                _, size, _, _, p = read_head(s, at)
                if _own_profile(s, p):
                    lanes.append((len(plans), first, size, base + at, base + p + 1, base + end))
                else:
                    (x,), _ = decode_frame(s, at, 8)
                    frames[first] = np.array(x, np.int8)
        else:
            while first < m["samples"]:
                (x,), offset = decode_frame(s, offset, 8)
                frames[first] = np.array(x, np.int8)
                first += len(x)
        plans.append((m, frames))
        base += len(s)
    if lanes:
        data = np.frombuffer(b"".join(streams), np.uint8)
        lanes.sort(key=lambda x: -x[2])
        index, first, size, start, warm, end = (np.array(c, np.int64) for c in zip(*lanes, strict=True))
        sums = crc16s(data, start, end - 2)
        if (sums != (data[end - 2].astype(np.uint16) << 8 | data[end - 1])).any():
            raise ValueError("a frame's CRC-16 is wrong")
        x, pos = _lanes(data, warm, size)
        if ((pos + 7 >> 3) != end - 2).any():
            raise ValueError("a frame doesn't end where the next begins")
        by_frame = np.ascontiguousarray(x.astype(np.int8).T)
        for i, (s, f, n) in enumerate(zip(index.tolist(), first.tolist(), size.tolist(), strict=True)):
            plans[s][1][f] = by_frame[i, :n]
    out = []
    for m, frames in plans:
        blocks = [(f, frames[f]) for f in sorted(frames)]
        if hashlib.md5(b"".join(x.tobytes() for _, x in blocks)).digest() != m["md5"]:
            raise ValueError("the samples' MD5 is wrong")
        out.append((m, [(f, (x.view(np.uint8) ^ 0x80).tobytes()) for f, x in blocks]))
    return out


def _in_parts(items: list, sizes: list[int], most: int):
    part, total = [], 0
    for item, n in zip(items, sizes, strict=True):
        part.append(item)
        total += n
        if total >= most:
            yield part
            part, total = [], 0
    if part:
        yield part


def encoded(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): every text's stream."""

    def run(batches):
        for batch in batches:
            rows = list(range(batch.num_rows))
            texts = batch.column("text").to_pylist()
            for part in _in_parts(rows, [len(t or "") + UNIT for t in texts], DECODE_AT_ONCE):
                payloads = [payload_of(texts[i]) for i in part]
                n = [len((texts[i] or "").encode("utf-8", "surrogatepass")) for i in part]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(part)), pa.array(n, pa.int64()), pa.array(encode_streams(payloads), pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def _decoding(media: DataFrame, schema: str, rows):
    """``rows(doc_id, n_bytes, stream, metadata, blocks)`` gives the rows of one stream."""
    kind = media.schema["doc_id"].dataType.simpleString()
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            streams = batch.column("media").to_pylist()
            n_bytes = batch.column("n_bytes").to_pylist()
            for part in _in_parts(list(range(len(streams))), [len(s) for s in streams], DECODE_AT_ONCE):
                out, at = [], []
                for i, (m, blocks) in zip(part, decode_streams([streams[i] for i in part]), strict=True):
                    new = rows(n_bytes[i], streams[i], m, blocks)
                    out += new
                    at += [i] * len(new)
                columns = list(zip(*out, strict=True)) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, types, strict=True))], ["doc_id", *names])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, {schema}")


def pcm_blocks(media: DataFrame) -> DataFrame:
    """(doc_id, sample, n, pcm): a row for each frame, with the offset of its first sample."""
    return _decoding(media, "sample long, n long, pcm binary", lambda n, stream, m, blocks: [(f, len(x), x) for f, x in blocks])


def features(media: DataFrame) -> DataFrame:
    """Per stream, from its decoded blocks: sizes, digests and sound features as text.

    feature: zero crossings around the middle value, mean and root mean square of the
    samples, each rounded, and the number of blocks.
    """

    def rows(n, stream, m, blocks):
        data = b"".join(x for _, x in blocks)
        x = np.frombuffer(data, np.uint8).astype(np.int64) - 128
        crossings = int(np.count_nonzero(np.diff(x > x.sum() // len(x))))
        feature = f"zc={crossings};mean={x.sum() / len(x):.3f};rms={(float((x * x).sum()) / len(x)) ** 0.5:.3f};blocks={len(blocks)}"
        return [(n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(stream), hashlib.sha256(stream).hexdigest(), feature)]

    return _decoding(media, "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", rows)


def stored(docs: DataFrame) -> DataFrame:
    """``encoded``, written to the shared folder and read again."""
    return written(encoded(docs), f"{shared_dir(docs.sparkSession)}/media")


