"""Byte-level BPE encoding and decoding with reuse of content-defined chunks."""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .hashing import SPACES, pieces

#: A chunk ends, on average, once in 2 ** CHUNK_BITS bytes.
CHUNK_BITS = 11
#: Bytes of chunks, and number of words, that a task remembers; beyond them it starts anew.
CHUNK_MEMORY, WORD_MEMORY = 32 << 20, 500_000
#: Bytes of new words that the tokenizer is given as one text.
STRETCH = 1 << 14
#: White space with the word that follows it.
WORD = re.compile(rb"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
#: White space other than the six ASCII characters, in UTF-8. Next to it no cut is known to be safe.
RARE_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def chunk_bounds(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where chunks begin, bounds of texts included: a cut follows each eight bytes whose hash has
    CHUNK_BITS leading zeros, so equal passages are cut alike wherever they stand."""
    n = len(data)
    if n < 9:
        return np.unique(bounds)
    window = np.zeros(n - 7, np.uint64)
    for i in range(8):
        part = data[i : i + (n - i) // 8 * 8].view("<u8")
        window[i::8] = part[: len(window[i::8])]
    with np.errstate(over="ignore"):
        cuts = np.flatnonzero((window * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CHUNK_BITS) == 0) + 8
    cuts = cuts[cuts < n]
    cuts = cuts[(data[cuts] & 0xC0) != 0x80]  # not within a character
    return np.unique(np.concatenate([cuts, bounds]))


class Chunk(NamedTuple):
    """A chunk's words and, where it has some between its first and its last, their packed ids."""

    words: list[bytes]
    ids: bytes | None


class ChunkEncoder:
    """Encodes as the given tokenizer does, each distinct chunk once.

    The pre-tokenizer's pattern matches no run in which white space follows something else, and its
    matches depend only on what stands from their start on; so every encoding of a text has a token
    boundary before white space that follows a visible character. A chunk is encoded from its first
    such place to its last. Chunks are then joined: a stretch that begins with the last encoded word
    of one and ends with the first encoded word of the next is encoded anew, and must begin and end
    with the very ids that these words have in their chunks; else it grows by a word on either side,
    until both ends agree. A chunk without such places becomes part of the stretch."""

    def __init__(self, tokenizer_json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = np.array([len(x) for x in byte_table(tokenizer_json)], np.int64)
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, Chunk] = {}
        self.held = 0

    @staticmethod
    def split(chunk: bytes) -> list[bytes]:
        return [chunk] if RARE_SPACE.search(chunk) else WORD.findall(chunk)

    def tokens(self, texts: list[bytes]) -> list[np.ndarray]:
        """What the tokenizer makes of each text."""
        out = []
        for at in range(0, len(texts), 256):
            out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([x.decode() for x in texts[at : at + 256]], add_special_tokens=False)]
        return out

    def learn(self, wanted: set[bytes]) -> None:
        """The packed ids of each wanted word. Words that begin with white space and end visibly are
        encoded as one text, which has token boundaries between them; the sizes of its tokens show
        where those are, and a text where one is missing is encoded word by word."""
        new = [w for w in wanted if w not in self.words]
        plain = [w for w in new if w[0] in SPACES and w[-1] not in SPACES and len(w) <= 64]
        single = list(set(new).difference(plain))
        ends = np.cumsum([len(w) for w in plain])
        cuts = np.searchsorted(ends, np.arange(STRETCH, (int(ends[-1]) if plain else 0) + STRETCH, STRETCH), "right").tolist()
        groups = [plain[a:b] for a, b in zip([0, *cuts], [*cuts, len(plain)], strict=True) if b > a]
        for group, ids in zip(groups, self.tokens([b"".join(g) for g in groups]), strict=True):
            stops, sizes = np.cumsum(self.size[ids]), np.cumsum([len(w) for w in group])
            at = np.searchsorted(stops, sizes)
            if len(stops) and stops[-1] == sizes[-1] and (stops[at] == sizes).all():
                packed = ids.tobytes()
                start = 0
                for w, end in zip(group, (4 * (at + 1)).tolist(), strict=True):
                    self.words[w] = packed[start:end]
                    start = end
            else:
                single += group
        for w, ids in zip(single, self.tokens(single), strict=True):
            self.words[w] = ids.tobytes()

    def learn_chunks(self, new: list[bytes]) -> None:
        split = [self.split(c) for c in new]
        self.learn({w for words in split for w in words[1:-1]})
        for chunk, words in zip(new, split, strict=True):
            self.chunks[chunk] = Chunk(words, b"".join(map(self.words.__getitem__, words[1:-1])) if len(words) > 2 else None)
            self.held += 2 * len(chunk)

    def seams(self, joins: list[tuple[list[bytes], bytes, list[bytes]]]) -> list[bytes]:
        """The packed ids between what is encoded of two chunks. A join has the words of the left
        chunk (none at a text's start), what stands between, and the words of the right chunk (none
        at its end); their outermost words are part of what stands between."""
        out: list[bytes] = [b""] * len(joins)
        reach, todo = 1, list(range(len(joins)))
        while todo:
            sides = [(joins[i][0][1:-1][-reach:], joins[i][2][1:-1][:reach]) for i in todo]
            made = self.tokens([b"".join((*left, joins[i][1], *right)) for i, (left, right) in zip(todo, sides, strict=True)])
            again = []
            for i, (left, right), ids in zip(todo, sides, made, strict=True):
                packed = ids.tobytes()
                head, tail = b"".join(map(self.words.__getitem__, left)), b"".join(map(self.words.__getitem__, right))
                if packed.startswith(head) and packed.endswith(tail) and len(packed) >= len(head) + len(tail):
                    out[i] = packed[len(head) : len(packed) - len(tail)]
                elif reach > max(len(joins[i][0]), len(joins[i][2])):
                    raise ValueError("chunks do not join: this tokenizer has no token boundaries before white space")
                else:
                    again.append(i)
            reach, todo = 2 * reach, again
        return out

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """The ids of each text."""
        if self.held > CHUNK_MEMORY:
            self.chunks, self.held = {}, 0
        if len(self.words) > WORD_MEMORY:
            self.words, self.chunks, self.held = {}, {}, 0
        cuts, whole = chunk_bounds(data, bounds), data.tobytes()
        first = np.searchsorted(cuts, bounds).tolist()
        pieces_ = [whole[a:b] for a, b in itertools.pairwise(cuts.tolist())]
        self.learn_chunks([c for c in dict.fromkeys(pieces_) if c not in self.chunks])
        texts: list[list[bytes | int]] = []
        joins: list[tuple[list[bytes], bytes, list[bytes]]] = []
        for a, b in itertools.pairwise(first):
            parts, left, between = [], [], b""
            for piece in pieces_[a:b]:
                chunk = self.chunks[piece]
                if chunk.ids is None:
                    between += piece
                    continue
                parts += [len(joins), chunk.ids]
                joins.append((left, between + chunk.words[0], chunk.words))
                left, between = chunk.words, chunk.words[-1]
            if between:
                parts.append(len(joins))
                joins.append((left, between, []))
            texts.append(parts)
        seams = self.seams(joins)
        return [np.frombuffer(b"".join(seams[x] if isinstance(x, int) else x for x in parts), np.uint32) for parts in texts]


def byte_table(tokenizer_json: str) -> list[bytes]:
    """The bytes of every id. The printable characters that vocabularies of this kind use stand for
    themselves, and those from U+0100 on for the remaining bytes, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))}
    model = json.loads(tokenizer_json)
    tokens = dict(model["model"]["vocab"]) | {x["content"]: x["id"] for x in model["added_tokens"]}
    table = [b""] * (max(tokens.values()) + 1)
    for token, i in tokens.items():
        table[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return table


class Decoder:
    def __init__(self, tokenizer_json: str) -> None:
        self.table = byte_table(tokenizer_json)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")

    def known(self, ids: list[int | None]) -> list[int]:
        return [i for i in ids if i is not None and 0 <= i < len(self.table)]


def _over(docs: DataFrame, tokenizer: str, make, schema: str, column: str) -> DataFrame:
    with open(tokenizer, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary: a fixed size
    return docs.select("doc_id", column).mapInArrow(lambda batches: make(batches, sent.value), schema)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (array of int) for every row of docs (doc_id, text): the ids the tokenizer file
    gives for the whole text without adding special tokens. Null and empty texts have no ids; null
    and repeated doc_id pass through; an empty table gives no rows; other columns are not looked at.
    There is no shuffle: chunks are shared within a task, so memory is bounded, and each task can be
    rerun alone."""

    def make(batches: Iterator[pa.RecordBatch], tokenizer_json: str) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer_json)
        for batch in batches:
            for rows, data, bounds in pieces(batch, "text"):
                ids = [x.astype(np.int32) for x in encoder.encode(data, bounds)]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids)))], ["doc_id", "ids"])

    return _over(docs, tokenizer, make, "doc_id long, ids array<int>", "text")


def decode(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text for every row of tokens (doc_id, ids); null ids are an empty text, null and
    unknown ids within a list stand for nothing."""

    def make(batches: Iterator[pa.RecordBatch], tokenizer_json: str) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(tokenizer_json)
        for batch in batches:
            texts = [decoder.decode(decoder.known(x or [])) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return _over(tokens, tokenizer, make, "doc_id long, text string", "ids")


def round_trip(docs: DataFrame, tokenizer: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass, digests of the
    ids (decimal, joined by commas) and of the decoded text (UTF-8); with ids also the ids."""

    def make(batches: Iterator[pa.RecordBatch], tokenizer_json: str) -> Iterator[pa.RecordBatch]:
        encoder, decoder = ChunkEncoder(tokenizer_json), Decoder(tokenizer_json)
        decimal = [str(i) for i in range(len(decoder.table))]
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for batch in batches:
            for rows, data, bounds in pieces(batch, "text"):
                made, out = encoder.encode(data, bounds), []
                for x in made:
                    x = x.tolist()
                    out.append((len(x), sha(",".join(map(decimal.__getitem__, x))), sha(decoder.decode(x))))
                n, a, b = zip(*out, strict=True)
                more = [pa.ListArray.from_arrays(np.cumsum([0, *n]).astype(np.int32), pa.array(np.concatenate(made).astype(np.int32)))] if ids else []
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b), *more], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if ids else [])])

    return _over(docs, tokenizer, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids, "text")
