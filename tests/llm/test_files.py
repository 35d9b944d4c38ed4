"""WARC and FLAC: round trips, checks, and defined results."""

import gzip
import hashlib
import random

import pytest

from shelfmark.llm import flac, warc


def test_warc_round_trip(spark):
    big, other = "<p>" + "x" * 200, "<p>é" + "y" * 150
    rows = [(5, "http://a", big), (3, "http://b", big), (9, None, big), (1, "c", "small"), (2, "d", "small"), (4, "e", None), (6, "f", other), (None, "g", other), (3, "b2", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.archive(pages)
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), r[1], r[2], r[3], str(r[4]))
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = {big: 3, other: 6}.get(html)
        again = first is not None and i != first
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=key) == sorted(expected, key=key)
    assert {bytes(r.payload) for r in got if r.page_id == 6} == {other.encode()}
    # the sidecar says where each member is, and every member is a gzip file of its own
    path = index.first().path.removeprefix("file://")
    data = open(path, "rb").read()
    for line in open(path + ".idx"):
        at, size, record_id, kind = line.split()
        assert gzip.decompress(data[int(at) : int(at) + int(size)]).startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode())


def test_warc_streams():
    record = warc.record_bytes(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), "response", None)
    whole = gzip.compress(record * 3)
    chunks = [whole[i : i + 7] for i in range(0, len(whole), 7)]
    assert [r for _, r in warc.records(warc.inflated(iter(chunks)))] == [record] * 3
    members = gzip.compress(record) + gzip.compress(record)
    assert len(list(warc.records(warc.inflated(iter([members]))))) == 2
    with pytest.raises(ValueError):
        list(warc.records(iter([record[:-3]])))


def test_warc_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_records(warc.archive(pages)).count() == 0


def payloads():
    rng = random.Random(4)
    noise = bytes(rng.randrange(256) for _ in range(192 * 30))
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "de"]) for _ in range(4000))
    return [flac.payload_of(x) for x in (None, "", "a", "é" * 500, text, "x" * 4608, "yz" * 2304)] + [noise, bytes(192), bytes(range(192)), b"\xff" * 192 + noise[: 192 * 25]]


def test_flac_round_trip():
    data = payloads()
    streams = flac.encode_streams(data)
    out = flac.decode_streams(streams)
    for p, s, (m, blocks) in zip(data, streams, out, strict=True):
        assert b"".join(x for _, x in blocks) == p and m["samples"] == len(p)
        assert [f for f, _ in blocks] == list(range(0, len(p), flac.BLOCK))
        at, plain = m["at"], b""
        while len(plain) < len(p):
            (x,), at = flac.decode_frame(s, at, 8)
            plain += bytes(v + 128 for v in x)
        assert plain == p and at == len(s)
    assert flac.encode_streams([data[4]])[0] == streams[4]


def test_flac_damage_is_found():
    (stream,) = flac.encode_streams([payloads()[4]])
    for at in (len(stream) - 200, len(stream) // 2, 30):
        bad = bytearray(stream)
        bad[at] ^= 4
        with pytest.raises((ValueError, KeyError, IndexError)):
            flac.decode_streams([bytes(bad)])


def test_flac_other_frames():
    """A fixed predictor of order 2 with two Rice partitions, and an escaped one, written by hand."""
    samples = [3, 5, 8, 9, 7, 4, 2, 1, 0, -1, -2, -4, -3, 0, 2, 5]

    def frame(escape):
        head = bytes([0xFF, 0xF8, 0x60, 0x02, 0, len(samples) - 1])
        bits = f"0{8 + 2:06b}0" + "".join(f"{v & 255:08b}" for v in samples[:2]) + "00" + f"{1:04b}"
        residual = [samples[i] - 2 * samples[i - 1] + samples[i - 2] for i in range(2, len(samples))]
        for part in (residual[:6], residual[6:]):
            if escape:
                bits += "1111" + f"{6:05b}" + "".join(f"{v & 63:06b}" for v in part)
            else:
                bits += f"{1:04b}"
                for v in part:
                    u = v << 1 ^ v >> 31
                    bits += "0" * (u >> 1) + "1" + str(u & 1)
        bits += "0" * (-len(bits) % 8)
        body = head + bytes([flac.crc8(head)]) + int(bits, 2).to_bytes(len(bits) // 8, "big")
        c = 0
        for b in body:
            c = (c << 8 & 0xFFFF) ^ int(flac.CRC16[c >> 8 ^ b])
        return body + c.to_bytes(2, "big")

    for escape in (False, True):
        (x,), end = flac.decode_frame(frame(escape), 0, 8)
        assert x == samples and end == len(frame(escape))


def test_flac_table(spark):
    docs = spark.createDataFrame([(1, "same"), (2, "same"), (None, None), (3, "z" * 9999)], "doc_id long, text string")
    media = flac.stored(docs)
    got = {r.doc_id: r for r in flac.features(media).collect()}
    assert got[1].media_sha256 == got[2].media_sha256 and got[1].feature == got[2].feature
    p = flac.payload_of("same")
    assert got[1].payload_sha256 == hashlib.sha256(p).hexdigest() and got[1].n_bytes == 4 and got[1].payload_bytes == 192 and got[None].n_bytes == 0
    blocks = sorted((r.sample, r.n) for r in flac.pcm_blocks(media).filter("doc_id = 3").collect())
    assert blocks == [(0, 4608), (4608, 4608), (9216, 9999 + (-9999 % 192) - 9216)]
    assert flac.features(flac.stored(docs.limit(0))).count() == 0
