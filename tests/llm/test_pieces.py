from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from studytrace.llm.pieces import CharacterMap, Encoder, encode_documents, model_path

TEXTS = [
    "", " ", "  a", "a ", "a  b", "▁", "▁a ▁", "x\0y", "日本語 テスト\U0001f600", "\n\n a\t b ",
    "<s> </s> <unk>", "a" * 3_000, " " * 300, "é́", "The quick brown fox. " * 50,
]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(model_path())


def test_ids_and_text_equal_the_library(encoder):
    for text, (ids, starts, decoded) in zip(TEXTS, encoder.encode(TEXTS), strict=True):
        want = encoder.library.encode(text)
        assert ids.tolist() == want and decoded == encoder.library.decode(want)
        assert len(starts) == len(ids) and (not text or starts[0] == 0)
        assert (starts[1:] >= starts[:-1]).all()


def test_spans_hold_their_pieces(encoder):
    text = "Ein Beispiel: ça va? 日本 ok"
    (ids, starts, _), raw = encoder.encode([text])[0], text.encode()
    for i, begin, end in zip(ids.tolist(), starts, [*starts[1:], len(raw)], strict=True):
        piece = encoder.library.id_to_piece(i)
        if not piece.startswith("<0x"):
            assert piece.replace("▁", " ").strip() == raw[begin:end].decode().strip()


def test_whole_texts_without_word_cache(encoder):
    plain = Encoder(model_path())
    plain.by_word = False
    for a, b in zip(plain.encode(TEXTS), encoder.encode(TEXTS), strict=True):
        assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def compiled(keys):
    """A tiny compiled map: one-byte keys and one two-byte key starting with 'a'."""
    units = [0] * 1024
    units[0] = 256 << 10  # children of the root lie at 256 ^ byte

    def leaf(at, value):
        units[at] = value | 1 << 31

    outputs, places = b"", {}
    for key, out in keys.items():
        places[key] = len(outputs)
        outputs += out + b"\0"
    node = 256 ^ ord("a")
    child = 512  # the node's children lie at 512 ^ byte, its value at 512
    units[node] = (child ^ node) << 10 | 1 << 8 | ord("a")
    leaf(child, places[b"a"])
    deeper = child ^ ord("b")
    end = 768
    units[deeper] = (end ^ deeper) << 10 | 1 << 8 | ord("b")
    leaf(end, places[b"ab"])
    body = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(body)) + body + outputs


def test_longest_prefix_of_a_character_map(encoder):
    found = CharacterMap(compiled({b"a": b"A", b"ab": b"xyz"}))
    assert found.longest(b"ab", 0) == (2, b"xyz") and found.longest(b"ac", 0) == (1, b"A")
    assert found.longest(b"b", 0) is None
    own = Encoder(model_path())
    own.characters = found
    text, origin = own.normalise("é ab a")
    assert text == "▁é▁xyz▁A"
    assert origin.tolist() == [0, 0, 0, 0, 0, 2, 2, 2, 3, 3, 3, 5, 5, 5, 6, 7]


def test_awkward_rows(awkward, awkward_rows, empty):
    rows = encode_documents(awkward, model_path()).collect()
    assert len(rows) == len(awkward_rows)
    assert sorted(r["decoded"] for r in rows) == sorted(r[1] or "" for r in awkward_rows)
    assert encode_documents(empty, model_path()).select(F.size("ids")).collect() == []


def test_query_digests_equal_the_library(spark, tmp_path, awkward, awkward_rows, encoder):
    import hashlib

    from studytrace.llm.pieces import op8_sentencepiece

    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    got = op8_sentencepiece(spark, str(tmp_path)).collect()
    want = []
    for row in awkward_rows:
        ids = encoder.library.encode(row[1] or "")
        texts = (",".join(map(str, ids)), encoder.library.decode(ids) if ids else "")
        want.append((row[0], len(ids), *[hashlib.sha256(t.encode()).hexdigest() for t in texts]))
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(repr, want)) == sorted(repr(tuple(r[n] for n in names)) for r in got)
