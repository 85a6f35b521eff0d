"""Packing of tokenised documents into fixed-length training sequences by
vector bin packing.

An example has three sizes: tokens, segments (one each) and loss-bearing
tokens; a sequence has a limit on each. A document longer than a sequence is
cut into whole sequences and a rest; rests and short documents are packed by
the dot-product heuristic: an open sequence takes, of all examples that still
fit, the one whose size vector has the largest weighted dot product with the
room that is left. Sequences that end up poorly filled give their examples
back to the pool; what is left at the end of a task is laid end to end, cut at
the sequence length, and the very last rest is cut at powers of two, which are
not padded.

Every task packs the documents of its own input partition, in pools of bounded
size: no shuffle, and a lost task is repeated with the same result. Sequence
numbers carry the task's number in their upper bits.

Rules: a NULL text is empty (its document is the end token alone); repeated
rows and NULL ids are packed like any other row; an empty table gives no
pieces.
"""

from __future__ import annotations

import json
import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import col, released

SCHEMA = ("id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, loss_tokens bigint, "
          "sequence_id bigint, offset bigint")
POOL = 2048
# The pre-tokenisation pattern of the byte-level vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# White space runs longer than this overflow the pattern's stack; they are cut out first.
RUN = 10_000
_LONG = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % RUN)


def _cache() -> dict:
    """One dict per Python worker (tasks unpickle their code anew)."""
    return sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__


def byte_bpe(path: str):
    """Encoder of a byte-level BPE vocabulary file (``tokenizers`` JSON): ids of
    the file, special tokens' strings as ordinary text."""
    got = _cache().get(path)
    if got is None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = {x["content"] for x in model.get("added_tokens", [])}
        # Byte-level vocabularies write byte b as a printable character: itself
        # where it is one, else the next free code point from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        got = _cache()[path] = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return got


def special_ids(path: str) -> dict:
    """The special tokens of a vocabulary file: their strings and ids."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if any(x.get(k) for x in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("special tokens that take in or ask for their surroundings are not supported")
    return {x["content"]: x["id"] for x in added}


def _plain(enc, text: str) -> list:
    """Ids of a text without special tokens. A long run of white space is a piece of its own
    but for its last character, which belongs to the word that follows."""
    out, at = [], 0
    for m in _LONG.finditer(text):
        end = m.end() - (m.end() < len(text))
        out += enc.encode_ordinary(text[at:m.start()])
        out += enc._core_bpe.encode_single_piece(text[m.start():end].encode())
        at = end
    return out + enc.encode_ordinary(text[at:])


def encode(enc, text: str, special: dict) -> list:
    """Ids of ``text``; the strings of ``special`` are their own ids wherever they stand."""
    if not special:
        return _plain(enc, text)
    out = []
    for x in re.split("(" + "|".join(re.escape(k) for k in sorted(special, key=len, reverse=True)) + ")", text):
        out += [special[x]] if x in special else _plain(enc, x)
    return out


class _Packer:
    """Packs pieces ``(doc, start, length, loss)`` as (sequence, offset).

    The first ``prompt`` tokens of a document bear no loss, all others do."""

    def __init__(self, limits, close_at: float):
        self.limits = np.array(limits, np.float64)
        self.close_at = close_at
        self.pool: list = []
        self.prompt: dict = {}
        self.next = 0
        self.done: list = []  # (sequence, offset, piece)

    def piece(self, doc, start: int, length: int) -> tuple:
        return doc, start, length, max(0, start + length - max(start, self.prompt.get(doc, 0)))

    def fitting(self, doc, start: int, length: int, loss_room: int) -> int:
        """The most tokens from ``start`` on that bear ``loss_room`` or less loss."""
        return min(length, max(0, self.prompt.get(doc, 0) - start) + loss_room)

    def sequence(self, pieces) -> None:
        at = 0
        for p in pieces:
            self.done.append((self.next, at, p))
            at += p[2]
        self.next += 1

    def add(self, doc, n: int, prompt: int = 0) -> None:
        cap, lim = int(self.limits[0]), int(self.limits[2])
        if prompt:
            self.prompt[doc] = prompt
        start = 0
        while start < n:
            p = self.piece(doc, start, self.fitting(doc, start, min(cap, n - start), lim))
            if p[2] == cap:
                self.sequence([p])
            else:
                self.pool.append(p)
            start += p[2]
        if len(self.pool) >= POOL:
            self.pack(False)

    def pack(self, last: bool) -> None:
        items, self.pool = self.pool, []
        if not items:
            return
        size = np.array([(p[2], 1, p[3]) for p in items], np.float64)
        # Weights: how scarce each kind of room is for this pool.
        w = size.mean(axis=0) / self.limits
        scaled = size * (w / self.limits)
        free = np.ones(len(items), bool)
        left, back = len(items), []
        while left:
            room, taken = self.limits.copy(), []
            while True:
                fit = free & (size <= room).all(axis=1)
                if not fit.any():
                    break
                score = np.where(fit, scaled @ (room / self.limits), -1.0)
                best = int(score.argmax())
                taken.append(best)
                free[best] = False
                left -= 1
                room -= size[best]
            used = 1 - room / self.limits
            if used.max() >= self.close_at or room[0] == 0:
                self.sequence([items[i] for i in taken])
            else:
                back += [items[i] for i in taken]
        if last or len(back) > POOL // 2:  # rests that do not combine
            self.lay(back)
        else:
            self.pool = back

    def lay(self, items) -> None:
        """End to end, cut at the limits; the last rest is cut at powers of two."""
        cap, row, used = int(self.limits[0]), [], np.zeros(3, np.int64)
        for doc, start, length, _ in items:
            while length:
                n = self.fitting(doc, start, min(length, cap - int(used[0])), int(self.limits[2]) - int(used[2]))
                if n <= 0 or used[1] >= self.limits[1]:
                    self.sequence(row)
                    row, used = [], np.zeros(3, np.int64)
                    continue
                row.append(self.piece(doc, start, n))
                used += (n, 1, row[-1][3])
                start, length = start + n, length - n
        total = sum(p[2] for p in row)
        while total:
            want = 1 << (total.bit_length() - 1)
            total -= want
            part = []
            while want:
                doc, start, length, _ = row.pop(0)
                n = min(length, want)
                part.append(self.piece(doc, start, n))
                if n < length:
                    row.insert(0, (doc, start + n, length - n, 0))
                want -= n
            self.sequence(part)


def _pack(path: str, end_id: int, limits, close_at: float, flush: int, special: bool):
    def rows(packer, docs, base):
        out = {k: [] for k in ("id", "start", "length", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset")}
        for seq, off, (doc, start, length, loss) in packer.done:
            key, ids = docs[doc]
            for k, v in zip(out, (key, start, length, ids[start:start + length].tobytes(), len(ids), loss, base + seq, off)):
                out[k].append(v)
        packer.done = []
        return pa.RecordBatch.from_arrays(
            [pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()], names=list(out))

    @released

    def run(batches):
        from pyspark import TaskContext

        enc, own = byte_bpe(path), special_ids(path) if special else {}
        base = TaskContext.get().partitionId() << 33
        packer, docs, n, held = _Packer(limits, close_at), {}, 0, 0
        for b in batches:
            keys = b.column(0).to_pylist()
            for k in range(b.num_rows):
                prompt = encode(enc, b.column(2)[k].as_py() or "", own)
                ids = np.array(prompt + encode(enc, b.column(1)[k].as_py() or "", own) + [end_id], "<u4")
                docs[n] = (keys[k], ids)
                packer.add(n, len(ids), len(prompt))
                n += 1
                held += len(ids)
                if held >= flush:
                    yield rows(packer, docs, base)
                    docs = {p[0]: docs[p[0]] for p in packer.pool}
                    packer.prompt = {d: v for d, v in packer.prompt.items() if d in docs}
                    held = 0
        packer.pack(True)
        yield rows(packer, docs, base)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   prompt_col: str | None = None, end_id: int = 1, max_tokens: int = 2048, max_segments: int = 512,
                   max_loss_tokens: int = 2048, close_at: float = 0.98, flush_tokens: int = 1 << 20,
                   special: bool = False) -> DataFrame:
    """One row per piece: ``id, start, length, ids`` (little-endian unsigned
    32-bit), ``doc_tokens, loss_tokens, sequence_id, offset``.

    For instruction data ``prompt_col`` names the text whose tokens stand first
    and bear no loss; in plain documents every token bears loss. With ``special`` the strings of
    special tokens are those tokens, as ``tokenizers`` has it by default; else they are ordinary text."""
    sizes = (max_tokens, max_segments, max_loss_tokens)
    if min(sizes) < 1:
        raise ValueError("limits must be positive")
    prompt = col(prompt_col) if prompt_col else F.lit(None)
    rows = docs.select(col(id_col).cast("bigint").alias("id"), col(text_col).cast("string").alias("text"),
                       prompt.cast("string").alias("prompt"))
    return rows.mapInArrow(_pack(tokenizer_path, end_id, sizes, close_at, flush_tokens, special), SCHEMA)
