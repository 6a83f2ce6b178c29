"""BPE encoding and decoding through distinct-word tables.

A text is split at special tokens and then by the tokenizer's own word pattern. Every Arrow batch
of documents adds its distinct words to the worker's table, the tokenizers library encodes those
that are new, and a document's ids are put together by looking its words up in order. Decoding goes the
other way through the id-to-piece table, whose size is that of the vocabulary.

The table is one per worker and bounded, not one for the corpus: joining a corpus-wide table back
by position would shuffle every word occurrence, several times the size of the texts.
"""

from __future__ import annotations

import hashlib
import json
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from coursewise.llm.common import map_texts

#: Fixed value: the word pattern of byte-level BPE tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters that this pattern and the tokenizers library are known to class alike. Their Unicode
#: versions differ in newer letters, so a text with other characters is split by the library.
KNOWN = r"[\u0000-\u0529\u2010-\u2070\u20a0-\u20bf\u2190-\u21ff\u3040-\u3096\u30a1-\u30fa\u4e00-\u9fd5\uac00-\ud7a3]*+"

#: A worker's word table is cut down to the words of the batch at hand when it holds more, and keeps
#: no longer words for the next batch: this bounds its memory (some 50 MB), not what is encoded.
TABLE_WORDS = 1 << 18
LONGEST_KEPT = 64


def read_tokenizer(path: str) -> str:
    """The tokenizer's JSON, read on the driver and sent with the job."""
    with open(path, encoding="utf-8") as file:
        return file.read()


@cache
def byte_of() -> dict[str, int]:
    """The byte of every character that byte-level vocabularies write for it."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Coder:
    """A byte-level BPE tokenizer taken apart: special tokens, word pattern, model, pieces."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        added = spec["added_tokens"]
        before = spec["pre_tokenizer"]
        if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or any(
            t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added
        ):
            raise ValueError("only plain byte-level tokenizers are supported")
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.pattern = regex.compile(PATTERN).findall
        self.known = regex.compile(KNOWN).fullmatch
        self.model = Tokenizer.from_str(source)
        self.model.no_truncation()
        self.model.no_padding()
        self.table: dict[str, bytes] = {}
        self.pieces = [b""] * self.model.get_vocab_size()
        for piece, i in spec["model"]["vocab"].items():
            self.pieces[i] = bytes(byte_of()[c] for c in piece)
        for content, i in self.special.items():
            self.pieces[i] = content.encode()

    def words(self, text: str) -> list[str]:
        if text.isascii() or self.known(text):
            return self.pattern(text)
        return [text[s:e] for _, (s, e) in self.model.pre_tokenizer.pre_tokenize_str(text)]

    def split(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.words(text)
        return [w for part in self.cut.split(text) for w in ([part] if part in self.special else self.words(part))]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        out = {}
        for at in range(0, len(words), 1 << 14):
            part = words[at : at + (1 << 14)]
            for word, found in zip(part, self.model.encode_batch_fast(part, add_special_tokens=False), strict=True):
                out[word] = b"".join(i.to_bytes(4, "little") for i in found.ids)
        return out

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        words = set().union(*split)
        if len(self.table) > TABLE_WORDS:
            self.table = {w: self.table[w] for w in words & self.table.keys()}
        found = self.encode_words([*(words - self.table.keys())])
        self.table.update(found)
        out = [b"".join(map(self.table.__getitem__, words)) for words in split]
        for word in found:
            if len(word) > LONGEST_KEPT:
                del self.table[word]
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.pieces.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@cache
def coder(source: str) -> Coder:
    """One per Python worker."""
    return Coder(source)


def encode_documents(docs: DataFrame, source: str) -> DataFrame:
    """doc_id and ids (array of ints) of every whole text; null counts as empty: no ids."""

    def build(batch: pa.RecordBatch) -> dict:
        found = coder(source).encode_texts([t or "" for t in batch.column("text").to_pylist()])
        return {"doc_id": batch.column("doc_id"), "ids": pa.array([memoryview(x).cast("I").tolist() for x in found], pa.list_(pa.int32()))}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), f"doc_id {kind}, ids array<int>", build)


def decode_documents(encoded: DataFrame, source: str) -> DataFrame:
    """doc_id and the text of ``ids``; null ids give an empty text, unknown ids raise an error."""

    def build(batch: pa.RecordBatch) -> dict:
        pieces = coder(source).pieces
        texts = [b"".join(pieces[i] for i in x or ()).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())}

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_texts(encoded.select("doc_id", "ids"), f"doc_id {kind}, text string", build)


def token_table(docs: DataFrame, source: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (see the contract).

    Null texts count as empty: no tokens, and the digests of nothing. Repeated rows come out
    repeated; other columns are not read.
    """

    def build(batch: pa.RecordBatch) -> dict:
        own, texts = coder(source), [t or "" for t in batch.column("text").to_pylist()]
        counts, ids, decoded = [], [], []
        for at in range(0, len(texts), 1000):
            for found in own.encode_texts(texts[at : at + 1000]):
                counts.append(len(found) // 4)
                ids.append(hashlib.sha256(found).hexdigest())
                decoded.append(hashlib.sha256(own.decode(found).encode()).hexdigest())
        return {
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_sha256": pa.array(ids, pa.string()),
            "decoded_sha256": pa.array(decoded, pa.string()),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs.select("doc_id", "text"), schema, build)
