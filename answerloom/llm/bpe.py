"""Byte-pair encoding by forced boundaries, and decoding.

A merge can only join two neighbouring bytes if some vocabulary token holds that pair of bytes side by side. So
wherever a pair occurs that stands inside no token at all, a token ends for certain. Texts are cut there, each
fragment is encoded by itself, and the ids are put together. White space and the rules that split words are such
cuts as well. Equal fragments have equal ids, so a task encodes each only once while its bounded memory holds.

The tokenizer file is read by each task from `path`, which every executor must be able to reach; it is not copied.
Supported are files of the form that lower-cases, splits words by a pattern and marks word ends with a suffix.

Cases: a null text is an empty one; an empty text has no ids and decodes to an empty text. Strings of special tokens
in a text give their ids, as in the tokenizer. Repeated rows are encoded each; other columns are not looked at;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space as Unicode has it; Python's own set also holds four separators (1C to 1F) that are not white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = re.compile(f"[{SPACE}]+")
NOT_SPACE_THOUGH_PYTHON_SAYS = re.compile("[\x1c-\x1f]")
#: Entries of the memory for chunks of text and for words, per task.
MEMORY = 600_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself where printable, else one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class ForcedBoundaryEncoder(dict):
    """Ids of chunks of text between white space, as little-endian 32-bit integers; a missing chunk is encoded."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for token, number in (self.ids | self.special).items():
            self.tokens[number] = token
        self.inside = {pair for token in self.ids for pair in self._pairs(token)}
        self.letters = byte_letters()
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern["pattern"]["Regex"].replace(r"\s", SPACE))
        self.specials = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.words: dict[str, bytes] = {}
        self.fragments: dict[tuple[str, bool], bytes] = {}

    def _pairs(self, token: str) -> zip:
        bare = token.removesuffix(self.suffix) if self.suffix else token
        return zip(bare, bare[1:], strict=False)

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        known = self.words
        out = []
        for word in self.split.findall(chunk):
            ids = known.get(word)
            if ids is None:
                if len(known) >= MEMORY:
                    known.clear()
                ids = known[word] = self.encode_word(word)
            out.append(ids)
        found = self[chunk] = b"".join(out)
        return found

    def encode_word(self, word: str) -> bytes:
        """Cut at the forced boundaries, encode the fragments, put their ids together."""
        letters = self.letters
        spelled = word if word.isascii() and word.isprintable() else "".join([letters[b] for b in word.encode()])
        inside, start, out, memory = self.inside, 0, [], self.fragments
        for at, pair in enumerate(zip(spelled, spelled[1:], strict=False), 1):
            if pair not in inside:
                out.append((spelled[start:at], False))
                start = at
        out.append((spelled[start:], True))
        if len(out) == 1:
            return self.merge(*out[0])
        ids = []
        for fragment in out:
            got = memory.get(fragment)
            if got is None:
                if len(memory) >= MEMORY:
                    memory.clear()
                got = memory[fragment] = self.merge(*fragment)
            ids.append(got)
        return b"".join(ids)

    def merge(self, fragment: str, ends_word: bool) -> bytes:
        """Join the pair of the lowest rank, everywhere it stands, until no pair is left that has a rank."""
        parts = list(fragment)
        if ends_word:
            parts[-1] += self.suffix
        rank, none = self.rank, 1 << 60
        while len(parts) > 1:
            ranks = [rank.get(pair, none) for pair in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == none:
                break
            if ranks.count(best) == 1:
                at = ranks.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                continue
            left, right = parts[(at := ranks.index(best))], parts[at + 1]
            joined, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == left and parts[i + 1] == right:
                    joined.append(left + right)
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            parts = joined
        return np.array([self.ids[p] for p in parts], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.specials is None or not self.specials.search(text):
            return self._encode_plain(text)
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += [self._encode_plain(text[at : found.start()]), np.array([self.special[found[0]]], "<u4").tobytes()]
            at = found.end()
        return b"".join([*out, self._encode_plain(text[at:])])

    def _encode_plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        # letter by letter, so that a capital sigma does not depend on what follows
        text = (text.replace("Σ", "σ") if "Σ" in text else text).lower()
        chunks = SPACES.split(text) if NOT_SPACE_THOUGH_PYTHON_SAYS.search(text) else text.split()
        return b"".join(map(self.__getitem__, chunks))

    def decode(self, ids: bytes) -> str:
        """The tokens with a space between, special ones too: the file names no decoder that would join them."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def encoder(path: str) -> ForcedBoundaryEncoder:
    return ForcedBoundaryEncoder(path)


def _over_texts(documents: DataFrame, key: str, text: str, function, columns: str) -> DataFrame:
    """function(texts) -> lists of column values, on batches."""
    source = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = function(part.column(1).to_pylist())
                yield pa.RecordBatch.from_pydict({"key": part.column(0)} | found)

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, {columns}").withColumnRenamed("key", key)


def encode_documents(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids: the ids of each whole text."""

    def run(texts: list[str]) -> dict:
        encode = encoder(path).encode
        ids = [np.frombuffer(encode(t), "<u4").astype("<i4") for t in texts]
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        flat = np.concatenate(ids) if ids else np.zeros(0, "<i4")
        return {"ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))}

    return _over_texts(documents, key, text, run, "ids array<int>")


def decode_documents(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text: the decoded text of each row of ids."""
    source = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path).tokens
        for batch in batches:
            texts = [" ".join([tokens[i] for i in x.as_py() or ()]) for x in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"key": batch.column(0), "text": pa.array(texts, pa.string())})

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def digest_documents(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens and the digests of the ids and of the decoded text, without the ids leaving their task."""

    def run(texts: list[str]) -> dict:
        work = encoder(path)
        ids = list(map(work.encode, texts))
        return {
            "n_tokens": [len(x) // 4 for x in ids],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(work.decode(x).encode()).hexdigest() for x in ids],
        }

    return _over_texts(documents, key, text, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
