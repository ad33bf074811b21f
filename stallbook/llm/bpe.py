"""BPE by dynamic programming over prefixes.

A piece of text has exactly one valid encoding, and so has each of its prefixes: its last token is
the one token ending there that is compatible with the last token of the prefix before it. An
Aho-Corasick automaton of the vocabulary reports, for each position, every token that is a suffix
of the text up to there. Two tokens are compatible if merging their text again gives these two,
which is tested by undoing merges at the seam. The last token of each prefix is stored; back
pointers from the end give the ids.

The file's vocabulary and merges are read from the folder of public tokenizers in each Python
worker and kept there. Encoded pieces are remembered up to ``REMEMBERED`` (memory only; results
do not depend on it).

Cases: null text is empty and has no tokens; special tokens in a text get their ids, as in the
library; any text decodes to itself, as every byte is a token.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.llm.frames import fresh, map_rows

VOCABULARY = "byte_bpe_50k.json"
REMEMBERED = 300_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class Pieces(dict):
    """Piece of text to packed ids (little-endian uint32), filled on demand; when full, only the last half survives."""

    def __init__(self, encode_piece: Callable[[str], bytes]):
        self.encode_piece, self.older = encode_piece, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode_piece(piece)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = {c: b for b, c in byte_letters().items()}
        to_bytes = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        vocab = {to_bytes(t): i for t, i in data["model"]["vocab"].items() if t not in self.special}
        self.token_bytes: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = token
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode("utf-8")
        # rank of each merge, and the merge that makes each token (tokens of one byte have none)
        self.ranks: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = vocab[to_bytes(left)], vocab[to_bytes(right)]
            self.ranks[pair] = rank
            made = vocab[to_bytes(left) + to_bytes(right)]
            if made not in self.halves:
                self.halves[made], self.made_at[made] = pair, rank
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if len(token) == 1 or i in self.halves:
                self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.seams: dict[int, bool] = {}
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.splitter = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pieces = Pieces(self.encode_piece)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the text of two tokens, merged by rank, ends up as just these two."""
        # Undo the later of both tokens' last merges; a merge across the seam that would have come
        # before the undone one (ties: leftmost first) rules the pair out.
        limit = 1 << 60
        while True:
            across = self.ranks.get((left, right))
            if across is not None and across < limit:
                return False
            made_left, made_right = self.made_at.get(left, -1), self.made_at.get(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                limit = made_left
                left = self.halves[left][1]
            else:
                # the seam comes first from the left, so it also wins a tie against the right token's merge
                limit = made_right + 1
                right = self.halves[right][0]

    def encode_piece(self, piece: str) -> bytes:
        """Packed ids of one piece: the last token of every prefix, then the way back from the end."""
        text = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1")
        n = len(text)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        seams = self.seams
        for end, (length, token) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            if end != length:
                before = last[end - length]
                if before < 0:
                    continue
                fits = seams.get(before << 20 | token)
                if fits is None:
                    if len(seams) >= REMEMBERED:
                        seams.clear()
                    fits = seams[before << 20 | token] = self.compatible(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        ids = []
        while n:
            ids.append(last[n])
            n -= size[n]
        return struct.pack(f"<{len(ids)}I", *reversed(ids))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, packed as little-endian uint32."""
        if not text:
            return b""
        out = []
        for i, part in enumerate(self.splitter.split(text) if self.splitter else [text]):
            if i % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out.extend(map(self.pieces.__getitem__, self.pattern.findall(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, text: str = "text", path: str | None = None, keep: list[str] | None = None, ids: str = "ids") -> DataFrame:
    """``keep`` (default: all columns) and the packed ids of every whole text."""
    path, keep = path or vocabulary_path(), docs.columns if keep is None else keep
    source = fresh(docs, "_text")

    def run(rows: dict[str, list]) -> dict[str, list]:
        encode = encoder(path).encode
        return {**{c: rows[c] for c in keep}, ids: [encode(t) for t in rows[source]]}

    return map_rows(docs.select(*keep, F.col(text).alias(source)), run, T.StructType(list(docs.select(*keep).schema.fields)).add(ids, "binary"))


def round_trips(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per document: id, n_tokens, and SHA-256 of the ids and of the text decoded from them."""
    path = path or vocabulary_path()

    def run(rows: dict[str, list]) -> dict[str, list]:
        coder = encoder(path)
        ids = [coder.encode(t) for t in rows["_text"]]
        return {
            "_id": rows["_id"],
            "n_tokens": [len(i) // 4 for i in ids],
            "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
            "decoded_sha256": [hashlib.sha256(coder.decode(i).encode("utf-8")).hexdigest() for i in ids],
        }

    kind = dict(docs.dtypes)[doc_id]
    out = map_rows(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")), run, f"_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("_id", doc_id)
