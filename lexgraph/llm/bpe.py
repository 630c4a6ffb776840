"""Byte-level BPE with a pair occurrence index.

The distinct pieces of a run of texts are laid out as one list of symbols. An index maps each pair of
neighbours to all its positions; the ranks that occur are taken in ascending order from a heap, each
is applied at all its positions, and the lists of the pairs beside them are updated. A merge only ever
makes pairs of later ranks active, so each rank is taken off the heap with all its positions known.
"""

from __future__ import annotations

import gc
import json
from hashlib import sha256
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexgraph.llm.common import arrow_pass, by_value, column, shared, text_rows, texts

by_value(__name__)

# Fixed values of the vocabulary format: white space, and the split of the text before merging.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
CUT_BY_SPLIT = SPACE + "\x1c\x1d\x1e\x1f"
PATTERN = rf"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"""


# Texts of so many bytes share an index: the more, the fewer steps in all.
ENCODED_BYTES = 6 << 20


class Vocabulary(NamedTuple):
    """What a tokenizer file holds.

    ``pairs`` are the mergeable pairs as ``left << SHIFT | right``, sorted; ``rank`` and ``merged`` stand beside
    them. ``special`` maps special strings to ids.
    """

    pairs: np.ndarray
    rank: np.ndarray
    merged: np.ndarray
    byte_ids: np.ndarray
    id_bytes: list[bytes]
    special: dict[str, int]


SHIFT = 24


def printable_bytes() -> dict[str, int]:
    """The format's letters for bytes: printable Latin-1 stands for itself, the others for code points from 256 up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(content: str) -> Vocabulary:
    """From the JSON of a byte-level BPE tokenizer file."""
    parsed = json.loads(content)
    vocab, letters = parsed["model"]["vocab"], printable_bytes()
    added = {t["content"]: t["id"] for t in parsed["added_tokens"]}
    id_bytes = [b""] * (1 + max([*vocab.values(), *added.values()]))
    for token, i in vocab.items():
        if token not in added:
            id_bytes[i] = bytes(letters[c] for c in token)
    for token, i in added.items():
        id_bytes[i] = token.encode()
    byte_ids = np.zeros(256, np.int64)
    for letter, b in letters.items():
        byte_ids[b] = vocab[letter]
    pairs = [p if isinstance(p, list) else p.split(" ") for p in parsed["model"]["merges"]]
    key = np.array([vocab[a] << SHIFT | vocab[b] for a, b in pairs], np.int64)
    merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
    # Of a pair that is listed twice the later rank holds, as in a map filled in order.
    order = np.argsort(key, kind="stable")
    order = order[np.append(key[order][1:] != key[order][:-1], True)] if len(order) else order
    return Vocabulary(key[order], order, merged[order], byte_ids, id_bytes, added)


def one_after_another(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Of places whose pairs overlap (aaa), those that merge when the left one goes first."""
    keep, taken = np.ones(len(at), bool), -1
    for i, (place, other) in enumerate(zip(at.tolist(), nxt.tolist())):
        if place == taken:
            keep[i] = False
        else:
            taken = other
    return at[keep]


class PairIndex:
    """Symbols of many pieces laid end to end, and for each rank the places where its pair stands."""

    def __init__(self, pieces: list[bytes], v: Vocabulary) -> None:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        body = v.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)].astype(np.int32)
        self.v = v
        # A mark of -1 ends each piece: no pair reaches over it.
        self.symbols = np.full(len(body) + len(pieces), -1, np.int32)
        self.symbols[np.arange(len(body)) + np.repeat(np.arange(len(pieces)), sizes)] = body
        self.after = np.arange(1, len(self.symbols) + 1, dtype=np.int32)
        self.before = np.arange(-1, len(self.symbols), dtype=np.int32)
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.pair_of = {int(r): i for i, r in enumerate(v.rank)}
        # In parts: each place is looked up once, and few of them at a time.
        for at in range(0, len(self.symbols) - 1, 1 << 19):
            places = np.arange(at, min(at + (1 << 19), len(self.symbols) - 1), dtype=np.int32)
            self.add(places, self.symbols[places], self.symbols[places + 1])

    def add(self, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Enter the places of the pairs that have a rank."""
        key = (left.astype(np.int64) << SHIFT) + right
        row = np.minimum(np.searchsorted(self.v.pairs, key), len(self.v.pairs) - 1)
        hit = (self.v.pairs[row] == key) & (left >= 0) & (right >= 0)
        at, rank = at[hit], self.v.rank[row[hit]]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, part in zip(rank[np.append(0, cuts)].tolist(), np.split(at, cuts)):
            known = self.places.get(r)
            if known is None:
                self.places[r] = [part]
                heappush(self.active, r)
            else:
                known.append(part)

    def merge(self) -> list[list[int]]:
        """Apply the active ranks in ascending order; ids of each piece."""
        symbols, after, before = self.symbols, self.after, self.before
        while self.active:
            rank = heappop(self.active)
            row = self.pair_of[rank]
            left, right = divmod(int(self.v.pairs[row]), 1 << SHIFT)
            at = np.sort(np.concatenate(self.places.pop(rank)))
            at = at[np.append(True, at[1:] != at[:-1])]
            # An earlier merge may have taken one of the two.
            at = at[symbols[at] == left]
            at = at[symbols[after[at]] == right]
            if left == right and len(at) > 1:
                at = one_after_another(at, after[at])
            if not len(at):
                continue
            merged = self.v.merged[row]
            gone = after[at]
            symbols[at], symbols[gone] = merged, -2
            far = after[at] = after[gone]
            before[far] = at
            near = before[at]
            beside = near[near >= 0]
            self.add(
                np.concatenate([beside, at]),
                np.concatenate([symbols[beside], symbols[at]]),
                np.concatenate([symbols[at[near >= 0]], symbols[far]]),
            )
        left = symbols[symbols != -2]
        ends, flat, begin, out = np.flatnonzero(left == -1).tolist(), left.tolist(), 0, []
        for end in ends:
            out.append(flat[begin:end])
            begin = end + 1
        return out


def merge_pieces(pieces: list[bytes], v: Vocabulary) -> list[list[int]]:
    """Ids of each piece, by one pair occurrence index over all of them."""
    if not len(v.pairs):
        return [v.byte_ids[np.frombuffer(p, np.uint8)].tolist() for p in pieces]
    return PairIndex(pieces, v).merge() if pieces else []


def chunk_splitter():
    """A function that cuts a text where no piece can reach over: before a single blank between two non-blanks."""
    import regex

    cut = regex.compile(f"(?<=[^{SPACE}])(?= [^{SPACE}])").split

    def chunks(text: str) -> list[str]:
        # As many white spaces as gaps between words: none stands beside another, or at an end.
        if sum(map(text.count, CUT_BY_SPLIT)) != len(text.split()) - 1:
            return cut(text) if text else []
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    return chunks


class Encoder:
    """Encodes runs of texts in one task. ``known`` has the ids of chunks; when there are too many, those that the run at hand has not are forgotten."""

    LIMIT = 140_000

    def __init__(self, v: Vocabulary) -> None:
        import regex

        self.v = v
        self.chunks = chunk_splitter()
        self.pieces = regex.compile(PATTERN).findall
        # Longest first, as one special string may begin another.
        names = sorted(v.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split
        self.known: dict[str, list[int]] = {}

    def parts(self, text: str) -> list[str]:
        """Chunks of the text; a special string is a chunk of its own."""
        if not any(name in text for name in self.v.special):
            return self.chunks(text)
        out = []
        for part in self.special(text):
            out.extend([part] if part in self.v.special else self.chunks(part))
        return out

    def split(self, chunk: str) -> list[str]:
        """Pieces of a chunk; letters with or without a blank before them are one piece."""
        if chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha()) or chunk in self.v.special:
            return [chunk]
        return self.pieces(chunk)

    def learn(self, bodies: list[str]) -> list[list[str]]:
        """Encode the chunks of the texts that are not known yet, all in one index; the chunks of each text."""
        parts = list(map(self.parts, bodies))
        wanted: set[str] = set().union(*parts)
        if len(self.known) + len(wanted) > self.LIMIT:
            self.known = {c: self.known[c] for c in wanted.intersection(self.known)}
        new = [c for c in wanted if c not in self.known]
        gc.disable()  # many small objects, no cycles
        try:
            pieces = list(map(self.split, new))
            distinct = list({p for found in pieces for p in found if p not in self.v.special})
            ids = dict(zip(distinct, merge_pieces([p.encode() for p in distinct], self.v)))
            ids |= {name: [i] for name, i in self.v.special.items()}
            for c, found in zip(new, pieces):
                self.known[c] = ids[found[0]] if len(found) == 1 else [i for p in found for i in ids[p]]
        finally:
            gc.enable()
        return parts


def decode(ids: list[int], v: Vocabulary) -> str:
    """The text of the ids; bytes that are no UTF-8 become replacement characters. Ids outside the vocabulary are skipped."""
    return b"".join(v.id_bytes[i] for i in ids if 0 <= i < len(v.id_bytes)).decode("utf-8", "replace")


def read_vocabulary(path: str) -> Vocabulary:
    """The driver reads the file, a parameter of bounded size; tasks get it by broadcast."""
    with open(path, encoding="utf-8") as file:
        return load_vocabulary(file.read())


def encode_documents(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """[doc_id, ids array<int>] of every whole text; null and empty texts have no ids."""
    sent = shared(docs.sparkSession, vocabulary)
    state: dict[str, Encoder] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state["encoder"] = Encoder(sent())
        encoder = state["encoder"]
        bodies = [t.decode("utf-8", "replace") for t in texts(batch)]
        parts = encoder.learn(bodies)
        known = encoder.known
        ids = [[i for c in chunks for i in known[c]] for chunks in parts]
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return arrow_pass(text_rows(docs, "doc_id"), work, f"doc_id {id_type}, ids array<int>", ENCODED_BYTES)


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """[doc_id, text] from [doc_id, ids]; null ids give an empty text."""
    sent = shared(encoded.sparkSession, vocabulary)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [decode(ids or [], sent()) for ids in column(batch, "ids").to_pylist()]
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return arrow_pass(encoded.select("doc_id", "ids"), work, f"doc_id {id_type}, text string")


def digest_documents(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """[doc_id, n_tokens, ids_sha256, decoded_sha256]: encoded and decoded again in one pass.

    The decimal form of a chunk's ids and the bytes they decode to are made from its ids once and joined for
    each text, which is what decoding all its ids in a row gives.
    """
    sent = shared(docs.sparkSession, vocabulary)
    state: dict = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state.update(encoder=Encoder(sent()), of=None, ids={}, bytes={})
        encoder = state["encoder"]
        bodies = [t.decode("utf-8", "replace") for t in texts(batch)]
        every = encoder.learn(bodies)
        known, id_bytes = encoder.known, encoder.v.id_bytes
        if state["of"] is not known:  # the encoder has forgotten its chunks
            state.update({name: {c: state[name][c] for c in known if c in state[name]} for name in ("ids", "bytes")}, of=known)
        decimals, decoded = state["ids"], state["bytes"]
        for c, ids in known.items():
            if c not in decimals:
                decimals[c] = ",".join(map(str, ids))
                decoded[c] = b"".join([id_bytes[i] for i in ids])
        counts, ids_sha, text_sha = [], [], []
        for parts in every:
            ids = ",".join(map(decimals.__getitem__, parts))
            back = b"".join(map(decoded.__getitem__, parts)).decode("utf-8", "replace")
            counts.append(ids.count(",") + 1 if ids else 0)
            ids_sha.append(sha256(ids.encode()).hexdigest())
            text_sha.append(sha256(back.encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    digests = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_pass(text_rows(docs, "doc_id"), work, f"doc_id {id_type}, {digests}", ENCODED_BYTES)
