"""Operator 8, packing: cost-balanced sequences of a fixed token length.

A document becomes its token ids and an end id.  Every task packs the
documents it reads in blocks of a bounded number of tokens.  A block with T
tokens opens T // length full sequences and, for the rest, sequences whose
lengths are the powers of two of T % length (those need no padding), so no
sequence holds any padding.  The estimated cost of a piece of n tokens is
``linear * n + quadratic * n * n`` (feed-forward and attention); documents go
in descending size to the lowest-cost sequence that still has room.  A
document longer than a sequence is cut into full sequences first; what fits
nowhere whole at the end fills the roomiest sequences in pieces.

No shuffle; memory is one block; the result depends only on how the input is
split, so a repeated task gives the same pieces.  Sequence ids are unique:
task number, then a counter.

Edge cases: null or empty text is the end id alone; repeated rows are packed
each (``start`` counts within the row); an empty table gives no pieces.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, pick, text_chunks, tokens_path, worker_cache
from quarry.sources.tables import load

TOKENIZER = "byte_bpe_50k.json"
LENGTH = 2048
END_ID = 1
BLOCK_TOKENS = 2_000_000
#: cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
SCHEMA = ("doc_id {id}, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, cost double")


def _tokenizer(path: str):
    """The tokenizer itself, loaded once per worker where it is needed."""
    state = worker_cache("tokenizer:" + path)
    if "tok" not in state:
        from tokenizers import Tokenizer
        state["tok"] = Tokenizer.from_file(path)
    return state["tok"]


def _ranks(path: str):
    """Where the vocabulary allows, the same merges as byte ranks: ids of a
    byte-level BPE are the same by both libraries, and the rank form is about
    three times as fast.  And the strings that only the tokenizer handles."""
    state = worker_cache("ranks:" + path)
    if "ranks" not in state:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        state["ranks"] = _rank_form(spec)
        state["special"] = [t["content"] for t in spec["added_tokens"]]
    return state["ranks"], state["special"]


def _rank_form(spec: dict):
    """The vocabulary as a rank table, or None if merges do not run in the
    order of ids (then the tokenizer itself is used for every text)."""
    import public_tokenizers
    import tiktoken
    model = spec["model"]
    if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    vocab, added = model["vocab"], {t["content"] for t in spec["added_tokens"]}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
    ids = [vocab[m] for m in merged]
    if ids != sorted(set(ids)) or spec["pre_tokenizer"].get("add_prefix_space"):
        return None
    ranks = {bytes(byte_of[c] for c in piece): i for piece, i in vocab.items() if piece not in added}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(path: str, texts: list[str | None]) -> list[bytes]:
    """Little-endian 32-bit ids of every text, as the tokenizer gives them."""
    ranks, special = _ranks(path)
    out = []
    for t in texts:
        if not t:
            out.append(b"")
        elif ranks is None or any(s in t for s in special):
            out.append(np.asarray(_tokenizer(path).encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes())
        else:
            out.append(array("I", ranks.encode_ordinary(t)).tobytes())
    return out


def piece_cost(n):
    return LINEAR * n + QUADRATIC * n * n


def pack_block(sizes: list[int], length: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document index, start, length, sequence, offset) of a block;
    every sequence is filled exactly."""
    pieces, rest, seq = [], [], 0
    for i, n in enumerate(sizes):
        start = 0
        while n - start >= length:
            pieces.append((i, start, length, seq, 0))
            seq, start = seq + 1, start + length
        if n > start:
            rest.append((n - start, i, start))
    total = sum(r[0] for r in rest)
    room = [length] * (total // length)
    tail = total % length
    room += [1 << b for b in reversed(range(tail.bit_length())) if tail >> b & 1]
    room = np.asarray(room, dtype=np.int64)
    full = room.copy()
    cost = np.zeros(len(room))
    left = []

    def place(s: int, n: int, i: int, start: int) -> None:
        pieces.append((i, start, n, seq + s, int(full[s] - room[s])))
        room[s] -= n
        cost[s] += piece_cost(n)

    rest.sort(key=lambda r: (-r[0], r[1]))
    for n, i, start in rest:
        fits = np.where(room >= n, cost, np.inf)
        s = int(fits.argmin())
        if fits[s] < np.inf:
            place(s, n, i, start)
        else:
            left.append((n, i, start))
    for n, i, start in left:
        while n:
            s = int(room.argmax())
            take = int(min(n, room[s]))
            place(s, take, i, start)
            n, start = n - take, start + take
    return pieces


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
         length: int = LENGTH, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of packed sequences with their ids (little-endian 32-bit)."""
    path = tokens_path(tokenizer)
    end = np.asarray([end_id], dtype="<u4").tobytes()
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = SCHEMA.format(id=source.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        keys: list[pa.Array] = []
        ids: list[bytes] = []
        tokens = opened = 0

        def flush():
            nonlocal opened
            sizes = [len(b) // 4 for b in ids]
            pieces = sorted(pack_block(sizes, length), key=lambda p: (p[3], p[4]))
            key = pa.concat_arrays(keys)
            for at in range(0, len(pieces), 2000):
                part = pieces[at:at + 2000]
                doc, start, n, seq, off = map(list, zip(*part))
                yield pa.RecordBatch.from_arrays(
                    [key.take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                     pa.array([ids[d][4 * s:4 * (s + k)] for d, s, k, _, _ in part], pa.binary()),
                     pa.array([sizes[d] for d in doc], pa.int64()),
                     pa.array([base + opened + q for q in seq], pa.int64()), pa.array(off, pa.int64()),
                     pa.array([piece_cost(k) for k in n], pa.float64())],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "cost"])
            opened += max(p[3] for p in pieces) + 1
            keys.clear()
            ids.clear()

        for (key,), texts in text_chunks(batches, limit=2 << 20):
            new = [b + end for b in encode(path, texts)]
            keys.append(key)
            ids.extend(new)
            tokens += sum(map(len, new)) // 4
            if tokens >= block_tokens:
                yield from flush()
                tokens = 0
        if ids:
            yield from flush()

    return source.mapInArrow(run, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The contract's columns: the checksum is taken over the real ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return digest(pack(pick(load(spark, sf_dir, "documents"), "doc_id", "text")))
