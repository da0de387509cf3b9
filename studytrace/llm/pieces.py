"""SentencePiece encoding and decoding that keeps every piece's source bytes.

The text is normalised by longest prefixes of the model's compiled character
map while the source position of every normalised byte is recorded; pieces are
then placed in the normalised text and projected back to byte spans.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.llm.common import table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
_SPACE_BYTES = SPACE.encode()
#: Distinct words whose pieces a worker remembers.
CACHE_WORDS = 200_000
BLOCK_CHARS = 1_000_000
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_BYTE_PIECE = 6  # fixed value: the model's type number of byte pieces


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8, and its outputs."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.outputs = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that starts at ``at``."""
        if not self.units:
            return None
        best, node = None, self._child(self.units[0])
        for i in range(at, len(source)):
            node ^= source[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & (1 << 31 | 0xFF) != source[i]:
                break
            node ^= self._child(unit)
            if unit >> 8 & 1:
                best = i + 1 - at, self.units[node] & (1 << 31) - 1
        if best is None:
            return None
        start = best[1]
        return best[0], self.outputs[start : self.outputs.index(b"\0", start)]

    @staticmethod
    def _child(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)


class Encoder:
    """One loaded model; lives in a worker and serves all its batches."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            data = file.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        rules, trainer = proto.normalizer_spec, proto.trainer_spec
        if rules.remove_extra_whitespaces or not rules.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("models that strip or do not escape white space are not supported")
        if not trainer.byte_fallback:
            raise ValueError("a model without byte pieces has no spans for unknown characters")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.characters = CharacterMap(rules.precompiled_charsmap)
        self.prefix = rules.add_dummy_prefix
        pieces = [(p.piece, p.type) for p in proto.pieces]
        self.lengths = np.array(
            [1 if kind == _BYTE_PIECE else len(piece.encode()) for piece, kind in pieces], np.int64
        )
        self.space_id = next((i for i, (p, _) in enumerate(pieces) if p == SPACE), None)
        # Pieces never reach over the start of a word, so words are cut apart first.
        self.by_word = (
            self.prefix
            and not self.characters.units
            and self.space_id is not None
            and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _ in pieces)
        )
        self.words: dict[str, bytes] = {}  # packed ids

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and the source byte of each of its bytes and of its end."""
        source = text.encode()
        if not source:
            return "", np.zeros(1, np.int32)
        if not self.characters.units:
            raw = np.frombuffer(source, np.uint8)
            places = np.arange(len(raw), dtype=np.int32)
            origin = np.repeat(places, np.where(raw == 0x20, len(_SPACE_BYTES), 1))
            out = text.replace(" ", SPACE)
        else:
            parts, places, at = [], [], 0
            while at < len(source):
                hit = self.characters.longest(source, at)
                if hit is None:
                    lead = source[at]
                    n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                    hit = n, source[at : at + n]
                piece = hit[1].replace(b" ", _SPACE_BYTES)
                parts.append(piece)
                places.append(np.full(len(piece), at, np.int32))
                at += hit[0]
            out, origin = b"".join(parts).decode(), np.concatenate(places)
        if self.prefix:
            out = SPACE + out
            origin = np.concatenate([np.zeros(len(_SPACE_BYTES), np.int32), origin])
        return out, np.append(origin, np.int32(len(source)))

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of the words not yet known, with one library call."""
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
            new = list(words)
        # The library puts the first space mark of a word back by itself.
        listed = self.library.encode([w[1:] for w in new], num_threads=1)
        for word, ids in zip(new, listed, strict=True):
            self.words[word] = array("i", ids if len(word) > 1 else [self.space_id]).tobytes()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, str]]:
        """Per text: ids, the first source byte of each piece, and the decoded text.

        A piece's span ends where the next one starts, the last at the text's
        end, so spans tile the source. Of a character that is replaced by
        several, and of the added leading space, all but the last piece may
        have an empty span.
        """
        normals = [self.normalise(text) for text in texts]
        if self.by_word:
            words = [_WORD.findall(normal) for normal, _ in normals]
            self._learn(set().union(*words))
            known = self.words.__getitem__
            listed = [np.frombuffer(b"".join(map(known, w)), np.int32) for w in words]
        else:
            listed = [np.array(self.library.encode(text), np.int32) for text in texts]
        out = []
        for ids, (_, origin) in zip(listed, normals, strict=True):
            places = np.concatenate([[0], np.cumsum(self.lengths[ids])])
            if places[-1] != len(origin) - 1:
                raise ValueError("pieces do not cover the normalised text")
            decoded = self.library.decode(ids) if len(ids) else ""
            out.append((ids, origin[places[:-1]], decoded))
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _blocks(texts: pd.Series) -> Iterator[list[str]]:
    """Runs of texts of about a million characters; a longer text stands alone."""
    block, held = [], 0
    for text in texts:
        block.append(text or "")
        held += len(block[-1])
        if held >= BLOCK_CHARS:
            yield block
            block, held = [], 0
    if block:
        yield block


def encoded(text: Column, model_path: str) -> Column:
    """A struct of ``ids``, ``starts`` (source bytes) and ``decoded`` text.

    ``model_path`` is a file on every worker. Null texts are empty texts, which
    have no pieces. Texts of any length are encoded whole.
    """

    @F.pandas_udf("ids array<int>, starts array<int>, decoded string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(model_path)
        for texts in batches:
            # One frame per block, so that no more than a block's arrays are held.
            for block in _blocks(texts):
                yield pd.DataFrame(encoder.encode(block), columns=["ids", "starts", "decoded"])

    return encode(text)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digested(text: Column, model_path: str) -> Column:
    """Number of pieces, and digests of what ``encoded`` gives, taken in the worker.

    Ids and starts are digested as decimal numbers joined by commas; the arrays
    themselves never leave the worker.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, starts_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(model_path)
        names = ["n_tokens", "ids_sha256", "decoded_sha256", "starts_sha256"]
        for texts in batches:
            for block in _blocks(texts):
                rows = []
                for ids, starts, decoded in encoder.encode(block):
                    listed = [_sha256(",".join(map(str, numbers.tolist()))) for numbers in (ids, starts)]
                    rows.append((len(ids), listed[0], _sha256(decoded), listed[1]))
                yield pd.DataFrame(rows, columns=names)

    return digest(text)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, starts, decoded) of every row; other columns are not read.

    Null and repeated ids are kept; a null text is an empty one.
    """
    return docs.select("doc_id", encoded(F.col("text"), model_path).alias("e")).select("doc_id", "e.*")


def model_path(name: str = MODEL) -> str:
    """Where the public tokenizer files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of ids, spans and decoded text of all documents.

    One row per document row; null texts are empty texts, which have no tokens.
    Null and repeated ids are kept as they are.
    """
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", digested(F.col("text"), model_path()).alias("e")).select("doc_id", "e.*")
