"""Byte-level BPE over distinct words: encoding by a walk over a trie of the words, and decoding.

Every prefix of a word has one encoding, so a trie node needs only its last token: the token that
ends there and that the merges would not join with the last token of the prefix before it. Words
are kept sorted, which is the depth-first order of their trie: the walk goes on from the depth a
word shares with the one before it, and shared prefixes are encoded once. Texts are cut into pieces
where no token can reach over; the words of the distinct pieces of a slice of texts are walked at once.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import annotate, kept_by_worker, table
from trajtable.llm.pieces import PieceEncoder, gather, plain

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: fixed value: the pattern of byte-level tokenizers that splits text into words
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PAIR = 24  # bits of a token id inside the key of a pair
REMEMBERED = 24_000_000  # bytes of pieces a Python worker remembers; a matter of speed only
SLICE_BYTES = 4_000_000  # text whose distinct pieces are encoded together
PAIRS = 200_000  # pairs of tokens a Python worker remembers before it starts anew; a matter of speed only


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merge ranks, the trie of the tokens and the special tokens of a byte-level BPE file, in flat tables."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        raw = {token: bytes(letter[c] for c in token) for token in spec["model"]["vocab"]}
        ids = {raw[token]: i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        n = max(ids.values()) + 1
        # the size of a token in bytes; the merge that makes it: its rank and its two parts
        self.sizes, self.rank, self.left, self.right = (array("i", [v]) * n for v in (0, -1, -1, -1))
        self.merged: dict[int, int] = {}  # rank by pair
        for b, i in ids.items():
            self.sizes[i] = len(b)
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = (raw[x] for x in (merge if isinstance(merge, list) else merge.split(" ")))
            whole = ids[left + right]
            self.merged[ids[left] << PAIR | ids[right]] = rank
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, ids[left], ids[right]
        self.pairs: dict[int, bool] = {}
        # the trie of the tokens: children by (node, byte), the token that ends at a node or -1
        self.child: dict[int, int] = {}
        self.token, parent = array("i", [-1]), array("q", [0])
        for b, i in ids.items():
            node = 0
            for byte in b:
                key = node << 8 | byte
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = len(self.token)
                    self.token.append(-1)
                    parent.append(key)
            self.token[node] = i
        # for each node the longest proper suffix of its bytes that is a node, and the nearest of its suffixes that is a token
        n = len(self.token)
        self.suffix, self.shorter = array("i", [0]) * n, array("i", [0]) * n
        depth = array("i", [0]) * n
        for node in range(1, n):  # parents come first
            depth[node] = depth[parent[node] >> 8] + 1
        for node in sorted(range(1, n), key=depth.__getitem__):
            up, byte = parent[node] >> 8, parent[node] & 255
            if up:
                self.suffix[node] = self.follow(self.suffix[up], byte)
            s = self.suffix[node]
            self.shorter[node] = s if self.token[s] >= 0 else self.shorter[s]

    def follow(self, node: int, byte: int) -> int:
        """The longest suffix of the node's bytes and ``byte`` that is a node."""
        found = self.child.get(node << 8 | byte)
        while found is None and node:
            node = self.suffix[node]
            found = self.child.get(node << 8 | byte)
        return found or 0

    def apart(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens beside each other as they are.

        The merges are undone from the latest on; at every stage the tokens at the seam must not
        have a merge of an earlier rank than the ones undone so far.
        """
        a, b, limit = left, right, 1 << 60
        while True:
            rank = self.merged.get(a << PAIR | b)
            if rank is not None and rank < limit:
                answer = False
                break
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                answer = True
                break
            if ra > rb:  # at equal rank the pair further left is merged first
                a, limit = self.right[a], ra
            else:
                b, limit = self.left[b], rb + 1
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        self.pairs[left << PAIR | right] = answer
        return answer

    def encode_words(self, words: Iterable[bytes]) -> tuple[list[bytes], list[int], array]:
        """Distinct words in order, where the ids of each begin, and all ids: a depth-first walk over the words' trie.

        Each depth of the path keeps its last token and the longest suffix that a token may begin with;
        the tokens that end there are the suffixes of that which are tokens, the longest tried first.
        """
        apart, pairs, follow, get = self.apart, self.pairs, self.follow, self.child.get
        token_at, shorter, sizes = self.token, self.shorter, self.sizes
        ordered, starts, ids = sorted(words), [], array("i")
        before, last, state = b"", [-1], [0]
        for raw in ordered:
            depth = 0
            for x, y in zip(raw, before):
                if x != y:
                    break
                depth += 1
            del last[depth + 1 :], state[depth + 1 :]
            node = state[depth]
            for end in range(depth, len(raw)):
                byte = raw[end]
                found = get(node << 8 | byte)
                node = follow(node, byte) if found is None else found
                at = node if token_at[node] >= 0 else shorter[node]
                while at:
                    token = token_at[at]
                    left = last[end + 1 - sizes[token]]
                    if left < 0:
                        break
                    fits = pairs.get(left << PAIR | token)
                    if fits is None:
                        fits = apart(left, token)
                    if fits:
                        break
                    at = shorter[at]
                else:
                    raise ValueError(f"no token ends at byte {end + 1} of {raw!r}")
                last.append(token)
                state.append(node)
            starts.append(len(ids))
            chain, end = [], len(raw)
            while end:
                chain.append(last[end])
                end -= sizes[last[end]]
            chain.reverse()
            ids.extend(chain)
            before = raw
        return ordered, starts, ids


class TokenBytes:
    """The bytes of all tokens end to end; an id that is not in use has none."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        known = {i: bytes(letter[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        known |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        parts = [known.get(i, b"") for i in range(max(known) + 2)]  # the last entry stands for unknown ids
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(parts), np.uint8)

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The text of each run of ids; bytes that are no UTF-8 become replacement characters."""
        ids = np.where((ids >= 0) & (ids < len(self.sizes) - 1), ids, len(self.sizes) - 1)
        data = gather(self.flat, self.starts[ids], self.sizes[ids])
        ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])]
        offsets = pa.py_buffer(ends.astype(np.int32))
        found = pa.Array.from_buffers(pa.string(), len(counts), [None, offsets, pa.py_buffer(data)])
        try:
            found.validate(full=True)
        except pa.ArrowInvalid:
            raw = data.tobytes()
            found = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends.tolist(), ends[1:].tolist())], pa.string())
        return found


def trie_encoder(path: str) -> PieceEncoder:
    vocabulary, split = Vocabulary(path), regex.compile(WORDS)

    def encode_new(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        number: dict[str, int] = {}
        words, sizes = array("i"), np.ones(len(pieces), np.int64)  # the words in order, and how many each piece has
        for i, p in enumerate(pieces):
            if p.isascii() and "'" not in p and plain(p):  # cut on both sides where words end: it is one
                words.append(number.setdefault(p, len(number)))
            else:
                found = split.findall(p)
                words.extend([number.setdefault(w, len(number)) for w in found])
                sizes[i] = len(found)
        raw = {w.encode("utf-8", "surrogatepass"): k for w, k in number.items()}
        ordered, starts, ids = vocabulary.encode_words(raw)
        place = np.empty(len(ordered), np.int64)
        place[[raw[b] for b in ordered]] = np.arange(len(ordered))
        starts = np.array(starts, np.int64)
        lengths = np.diff(starts, append=len(ids))
        which = place[np.frombuffer(words, np.int32)]
        total = np.concatenate([[0], np.cumsum(lengths[which])])
        ends = np.cumsum(sizes)
        return gather(np.frombuffer(ids, np.int32), starts[which], lengths[which]), total[ends] - total[ends - sizes]

    return PieceEncoder(encode_new, vocabulary.special, REMEMBERED)


def id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))


def encode(docs: DataFrame, tokenizer: str | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (default: all) and ``n_tokens``, ``ids`` of each whole text.

    A null or empty text has no ids; a special token's string in a text is that token. A result
    column replaces an input column of the same name. ``tokenizer`` is the path of a byte-level BPE
    file that every executor can read.
    """
    path = tokenizer or default_tokenizer()

    def prepare():
        encoder = kept_by_worker(f"trie:{path}", lambda: trie_encoder(path))

        def work(texts: pa.Array) -> dict[str, pa.Array]:
            ids, counts = encoder(texts)
            return {"n_tokens": pa.array(counts, pa.int64()), "ids": id_lists(ids, counts)}

        return work

    return annotate(docs, [("n_tokens", "bigint"), ("ids", "array<int>")], prepare, text, keep, SLICE_BYTES)


def decode(encoded: DataFrame, tokenizer: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns but ``ids``, and the text of the ids, special tokens included.

    Bytes that are no UTF-8 become replacement characters, unknown ids nothing; null is empty.
    """
    path = tokenizer or default_tokenizer()
    keep = [c for c in encoded.columns if c not in (ids, out)]
    schema = encoded.select(*keep).withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = kept_by_worker(f"bytes:{path}", lambda: TokenBytes(path))
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                lists = part.column(len(keep))
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], token.texts(flat, counts)], names=[*keep, out])

    return encoded.select(*keep, ids).mapInArrow(run, schema)


def sha256_hex(text):
    return F.sha2(text.cast("binary"), 256)


def op1_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents"), keep=["doc_id"])
    digest = sha256_hex(F.array_join(F.col("ids").cast("array<string>"), ","))
    decoded = decode(encoded.withColumn("ids_sha256", digest))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", sha256_hex(F.col("decoded")).alias("decoded_sha256"))
