import hashlib
import zlib

import public_tokenizers as P
import tiktoken

from quarrystone.llm import bpe, media

TEXTS = [None, "", " ", "a", "x" * 192, "é" * 96 + "!", "word " * 3000, "日本\n\t it's 123 ''", "same", "same", "\x00\x1c\x85  ​", "🙂" * 500]


def docs(spark):
    return spark.createDataFrame([(k, t, "clash") for k, t in enumerate(TEXTS)] + [(None, "no id", "x"), (3, "a", "again")], "doc_id bigint, text string, ids string")


def test_bpe_as_the_library(spark):
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    real = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.encode(docs(spark), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        want = real.encode_ordinary(text)
        assert r.ids == ",".join(map(str, want)) and r.n_tokens == len(want) and bytes(r.decoded) == text.encode()


def test_merges_of_one_long_piece():
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    real = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for piece in ("a" * 2000, "ab" * 999 + "c", "thethethe" * 300, "éèê" * 200):
        assert bpe.merge(piece.encode(), ranks) == real.encode_ordinary(piece)


def test_matches_are_dropped_and_learned_again(monkeypatch):
    monkeypatch.setattr(bpe, "KEEP", 3)
    codec = bpe.Codec(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    text = " ".join(f"w{k % 7}" for k in range(50))
    for _ in range(3):
        assert codec.both(text)[1] == ",".join(map(str, codec.encode(text)))


def test_media_round_trip(spark):
    stored = media.media(docs(spark))
    full, rows = {(r.doc_id, bytes(r.payload)): r for r in stored.collect()}, media.digest(stored).collect()
    assert len(rows) == len(TEXTS) + 2
    features = {}
    for r in rows:
        data = (b"no id" if r.doc_id is None else (TEXTS[r.doc_id] or "").encode())
        payload = data + b" " * (-len(data) % 192 or 192 * (not data))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        f = full[r.doc_id, payload]
        assert bytes(f.wav) == media.to_wav(payload) and media.from_wav(bytes(f.wav)) == payload and r.media_bytes == len(f.wav) and r.media_sha256 == hashlib.sha256(bytes(f.wav)).hexdigest()
        assert len(f.frames) == len(f.codes) and list(f.frames) == sorted(f.frames) and all(x < len(payload) / media.HOP for x in f.frames)
        assert features.setdefault(data, r.feature) == r.feature
    assert len(set(features.values())) >= 5


def test_fingerprint_of_a_tone():
    import numpy as np

    tone = (128 + 90 * np.sin(2 * np.pi * 1000 / media.RATE * np.arange(media.BLOCK * 10))).astype(np.uint8).tobytes()
    frames, codes = media.fingerprint(tone)
    assert len(codes) and {c >> 12 for c in codes.tolist()} & {round(1000 * media.FRAME / media.RATE)}


def test_many_pieces_are_merged_at_once(monkeypatch):
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    monkeypatch.setattr(bpe, "COLUMNS", 50)
    codec = bpe.Codec(ranks, P.PATTERN)
    text = "thé qu_iéck日本zx ÿabab"
    pieces = [(text * 9)[a : a + n].encode() for a in range(20) for n in range(1, 70)] + [b"\xff\x00\xfe" * k for k in range(1, 60)]
    calls, scalar = [], bpe.merge
    monkeypatch.setattr(bpe, "merge", lambda piece, ranks: calls.append(len(piece)) or scalar(piece, ranks))
    assert codec.merged(pieces) == [scalar(p, ranks) for p in pieces]
    assert all(n > bpe.WIDEST for n in calls)
    repeated = "w1 " + "x" * 70 + " w1\n" + "é" * 200
    real = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert codec.all([repeated, "", repeated]) == [(len(i), ",".join(map(str, i)), t.encode()) for t in (repeated, "", repeated) for i in [real.encode_ordinary(t)]]
    assert max(map(len, codec._kept)) <= bpe.LONG
