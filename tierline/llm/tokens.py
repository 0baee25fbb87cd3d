"""Token ids in an entropy-coded file format (operator 6).

Writing: documents are range-partitioned by id and sorted (ties by text), each
task tokenises its texts in order, appends the end id to every document, and
cuts its stream into segments of whole documents of about ``SEGMENT`` ids. A
segment is one record of the file: its frequency table, shared by all of its
blocks, and the blocks, coded by a static range asymmetric numeral system.

A block holds up to ``LANES * STEPS`` ids in ``LANES`` interleaved streams that
share one word sequence; it is decoded on its own. Its entry in the index is a
checkpoint: where its ids and its words begin, the lanes' states there and
again every ``CHECK_EVERY`` steps, and the crc32 of its ids. So any block, or
any part of one from a checkpoint on, can be decoded by itself, and blocks of a
segment are decoded side by side as array lanes.

Reading: ``read_documents`` decodes the records in parallel, checks every
block's crc32 and gives ids back per document with their global offset. The
offsets need one number per written partition on the driver.

Files are Parquet with one record per row, written by Spark's committer, so
retried tasks leave no halves and any store Spark reaches will do.

Tokenising: byte-level BPE works within pieces that begin at a space after
non-space, so the library encodes each distinct piece once and texts are put
together from the pieces' ids, by array lookups of the pieces' numbers. A worker
keeps ``PIECES`` of them; beyond that it forgets the half it met least. Texts
with other space patterns, and tokenizers of another kind, go to the library
whole.

Defined results: null and empty texts have the end id only; null doc_ids come
first; rows with equal doc_id follow each other in order of their text; an
empty table writes an empty file set. Very long texts make a segment of their
own. Only id and text are read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import work_root

END_ID = 2
SEGMENT = 1 << 21       # ids of a segment, about
LANES = 32
STEPS = 512
CHECK_EVERY = 256
MIN_BITS = 18           # the frequencies of a table sum to 2 ** bits
LOW = np.uint64(1 << 31)
PIECES = 1_000_000
AT_ONCE = 20_000
GROUP_CHARS = 2_000_000

BLOCK = np.dtype([("ids", "<u4"), ("word", "<u4"), ("crc32", "<u4")])
RECORD = ("part int, first_id long, n_ids long, doc_ids array<long>, doc_lens array<long>, "
          "bits int, table binary, blocks binary, states binary, checks binary, words binary")


# ---- tokenizer ---------------------------------------------------------------------
class _Numbers(dict):
    """Numbers strings in the order they are first asked for; ``new`` lists
    those numbered since it was last emptied."""

    def __init__(self, strings: list[str]):
        super().__init__(zip(strings, range(len(strings)), strict=True))
        self.new: list[str] = []

    def __missing__(self, string: str) -> int:
        n = self[string] = len(self)
        self.new.append(string)
        return n


class Encoder:
    """Ids of texts under a tokenizers file."""

    _loaded: dict[str, Encoder] = {}
    _LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
    _MARKED = re.compile(f"(\0?[{_LETTERS}]+)([!-/:-@\\[-`{{-~]*)\\Z")
    _LINES = re.compile(r"\0?[^\s\0]+(?:\n[^\s\0]+)+\Z")
    _SPACE = re.compile(r"\s|\A\Z")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True           # their strings in a text are plain text
        spec = json.loads(self.tok.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                         and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout"))
        self.line = np.array(self.tok.encode("\n", add_special_tokens=False).ids)
        self.apart = self.by_piece and len(self.line) == 1 and all(
            t.get("special") for t in spec.get("added_tokens") or [])
        if self.apart:                                  # letters as the model knows them
            seen = self.tok.pre_tokenizer.pre_tokenize_str
            self.space = seen(" a")[0][0][:-1]
            self.letters = {c: seen(chr(c))[0][0] for c in range(0xC0, 0x250) if chr(c).isalpha()}
        self._keep([], np.zeros(0, np.int64))

    @classmethod
    def load(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts one after another, how many each has)."""
        raw = self._library(texts)
        return (np.frombuffer(b"".join(raw), "<u4"),
                np.fromiter(map(len, raw), np.int64, len(raw)) // 4)

    def _lines(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_alone`` of texts without white space but a space before them: a
        line each of one text, as the end of a line is a piece of its own."""
        if self.apart:
            ids = np.frombuffer(self._library(["\n".join(texts) + "\n"])[0], "<u4")
            ends = np.flatnonzero(ids == self.line[0])
            if len(ends) == len(texts):
                return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1
        return self._alone(texts)

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_alone`` of letters, with or without a space before them: nothing
        is left to cut, so the library's model gets them as they are."""
        if not self.apart:
            return self._alone(texts)
        model, letters, space = self.tok.model.tokenize, self.letters, self.space
        ids: list[int] = []
        ends = []
        for text in texts:
            word = text if text.isascii() else text.translate(letters)
            ids += [t.id for t in model(space + word[1:] if word[0] == " " else word)]
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.diff(np.array(ends), prepend=0)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > GROUP_CHARS:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _keep(self, pieces: list[str], numbers: np.ndarray) -> None:
        """Forgets all pieces but those of ``numbers``."""
        if len(numbers):
            self.ids, self.lens = self._gather(numbers)
            self.opens, self.closes = self.opens[numbers], self.closes[numbers]
            self.seen = self.seen[numbers]
        else:
            self.ids, self.lens = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            self.opens = self.closes = np.zeros(0, bool)
            self.seen = np.zeros(0, np.int64)
        self.first = np.cumsum(self.lens) - self.lens
        self.number = _Numbers(pieces)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces one after another, how many each has)."""
        lens = self.lens[numbers]
        at = np.repeat(self.first[numbers] - np.cumsum(lens) + lens, lens)
        at += np.arange(len(at))
        return self.ids[at], lens

    def _learn(self) -> None:
        """Ids of the new pieces. Letters, the marks after them and the ends of
        lines between them are apart to the tokenizer: "word," is "word" and ","."""
        number, new = self.number, self.number.new
        base = len(self.lens)
        words: list[int] = []
        bare: list[int] = []
        alone: list[int] = []
        marked: dict[int, tuple] = {}
        lines: dict[int, list] = {}
        for i, p in enumerate(new):                     # grows: parts may be new
            if p.isascii() and p.isalpha():
                words.append(i)
            elif m := self._MARKED.match(p):
                if m[2]:
                    marked[i] = number[m[1]], number["\0" + m[2]]
                else:
                    words.append(i)
            elif not self._SPACE.search(p):
                bare.append(i)
            elif self._LINES.match(p):
                head, *rest = p.split("\n")
                lines[i] = [number[head]]
                for x in rest:
                    lines[i] += [number["\0\n"], number["\0" + x]]
            else:
                alone.append(i)
        pad = np.zeros(len(new), np.int64)
        self.first, self.lens = np.r_[self.first, pad], np.r_[self.lens, pad]
        self.seen = np.r_[self.seen, pad]
        self.opens, self.closes = np.r_[self.opens, pad > 0], np.r_[self.closes, pad > 0]
        for some, library in ((words, self._words), (bare, self._lines), (alone, self._alone)):
            for k in range(0, len(some), AT_ONCE):
                part = some[k:k + AT_ONCE]
                self._put(base, part, *library([new[i][1:] if new[i][:1] == "\0" else " " + new[i]
                                                for i in part]))
        for made in (marked, lines):                    # lines hold marked words
            if made:
                ids, lens = self._gather(np.array([n for parts in made.values() for n in parts]))
                sizes = np.fromiter(map(len, made.values()), np.int64, len(made))
                self._put(base, list(made), ids, np.add.reduceat(lens, np.cumsum(sizes) - sizes))
        for i in [*alone, *lines]:
            text = new[i].lstrip("\0")
            self.opens[base + i] = not text or text[0].isspace()
            self.closes[base + i] = not text or text[-1].isspace()
        new.clear()

    def _put(self, base: int, some: list[int], ids: np.ndarray, lens: np.ndarray) -> None:
        at = base + np.array(some)
        self.first[at] = len(self.ids) + np.cumsum(lens) - lens
        self.lens[at] = lens
        self.ids = np.r_[self.ids, ids]

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        get = self.number.__getitem__
        flat: list[int] = []
        ends = []
        for text in texts:
            if self.by_piece and "\0" not in text:
                first, *rest = text.split(" ")
                # a piece is known by its text after the space; a first one by a mark before it
                if first:
                    flat.append(get("\0" + first))
                flat.extend(map(get, rest))
            ends.append(len(flat))
        self._learn()
        numbers = np.array(flat, np.int64)
        ids, lens = self._gather(numbers)
        id_ends = np.r_[0, np.cumsum(lens)]
        # white space, a space, and white space or the end: no piece begins at this space
        runs = np.flatnonzero(self.closes[numbers[:-1]] & self.opens[numbers[1:]])
        text_of = np.searchsorted(ends, runs, side="right")
        whole = set(text_of[text_of == np.searchsorted(ends, runs + 1, side="right")].tolist())
        a = 0
        for i, (text, b) in enumerate(zip(texts, ends, strict=True)):
            if i in whole or not self.by_piece or "\0" in text:
                yield self._library([text])[0]
            else:
                yield ids[id_ends[a]:id_ends[b]].tobytes()
            a = b
        self.seen += np.bincount(numbers, minlength=len(self.seen))
        if len(self.number) > PIECES:
            most = np.sort(np.argsort(-self.seen, kind="stable")[:PIECES // 2])
            pieces = list(self.number)
            self._keep([pieces[n] for n in most.tolist()], most)


# ---- coder -------------------------------------------------------------------------
def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, frequencies that sum to 2 ** bits, bits)."""
    counts = np.bincount(ids)                           # as long as the vocabulary
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    bits = max(MIN_BITS, int(len(symbols)).bit_length() + 2)
    spare = (1 << bits) - len(symbols)
    freq = 1 + counts * spare // max(1, counts.sum())
    freq[np.argmax(counts)] += (1 << bits) - freq.sum()
    return symbols.astype(np.uint32), freq.astype(np.uint64), bits


def encode_segment(ids: np.ndarray) -> dict:
    """The coded fields of a record."""
    symbols, freq, bits = frequency_table(ids)
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    steps = max(1, min(STEPS, -(-len(ids) // LANES)))
    size = LANES * steps
    n_blocks = -(-len(ids) // size)
    number = np.zeros(int(symbols[-1]) + 1, np.int32)
    number[symbols] = np.arange(len(symbols))
    at = number[ids]
    padded = np.full(n_blocks * size, np.argmax(freq), np.int64)
    padded[:len(at)] = at
    grid = padded.reshape(n_blocks, steps, LANES)
    x = np.full((n_blocks, LANES), LOW, np.uint64)
    put = np.zeros((n_blocks, steps, LANES), bool)
    word = np.zeros((n_blocks, steps, LANES), np.uint32)
    marks = list(range(CHECK_EVERY, steps, CHECK_EVERY))
    checks = np.zeros((n_blocks, len(marks), LANES), np.uint64)
    shift, top = np.uint64(bits), np.uint64(63 - bits)
    for t in range(steps - 1, -1, -1):
        f, c = freq[grid[:, t]], start[grid[:, t]]
        full = x >= (f << top)
        put[:, t], word[:, t] = full, (x & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        x = (q << shift) + (x - q * f) + c
        if t in marks:
            checks[:, marks.index(t)] = x
    words = word[put].astype("<u4")                     # per block by step, then lane
    per_block = put.sum(axis=(1, 2))
    before = np.stack([put[:, :m].sum(axis=(1, 2)) for m in marks], axis=1) if marks \
        else np.zeros((n_blocks, 0), np.int64)
    blocks = np.zeros(n_blocks, BLOCK)
    blocks["ids"] = np.minimum(size, len(ids) - np.arange(n_blocks) * size)
    blocks["word"] = np.concatenate([[0], np.cumsum(per_block)[:-1]])
    raw = ids.astype("<u4")
    blocks["crc32"] = [zlib.crc32(raw[i:i + size].tobytes()) for i in range(0, len(raw), size)]
    table = np.concatenate([np.diff(symbols, prepend=np.uint32(0)), freq.astype(np.uint32)])
    return {"bits": bits, "table": zstandard.compress(table.astype("<u4").tobytes(), 3),
            "blocks": np.uint32(steps).tobytes() + blocks.tobytes(),
            "states": x.astype("<u8").tobytes(),
            "checks": before.astype("<u4").tobytes() + checks.astype("<u8").tobytes(),
            "words": words.tobytes()}


class Segment:
    """A record's coded fields, ready to decode."""

    def __init__(self, bits: int, table: bytes, blocks: bytes, states: bytes, checks: bytes,
                 words: bytes):
        self.bits = bits
        t = np.frombuffer(zstandard.decompress(table), "<u4")
        self.symbols = np.cumsum(t[:len(t) // 2], dtype=np.uint32)
        freq = t[len(t) // 2:].astype(np.uint64)
        self.freq, self.start = freq, np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(freq)), freq.astype(np.int64))
        self.steps = int(np.frombuffer(blocks[:4], "<u4")[0])
        self.blocks = np.frombuffer(blocks[4:], BLOCK)
        n, k = len(self.blocks), max(0, -(-self.steps // CHECK_EVERY) - 1)
        self.states = np.frombuffer(states, "<u8").reshape(n, LANES)
        self.check_word = np.frombuffer(checks[:4 * n * k], "<u4").reshape(n, k)
        self.check_state = np.frombuffer(checks[4 * n * k:], "<u8").reshape(n, k, LANES)
        self.words = np.frombuffer(words, "<u4")

    def decode(self, first: int = 0, last: int | None = None, check: int = 0) -> np.ndarray:
        """Ids of blocks ``first`` to ``last`` (exclusive), side by side, each
        from its checkpoint number ``check`` on (0: its start). Whole blocks
        are held against their crc32."""
        b = self.blocks[first:last]
        if check:
            x = self.check_state[first:last, check - 1].astype(np.uint64)
            at = b["word"].astype(np.int64) + self.check_word[first:last, check - 1]
        else:
            x, at = self.states[first:last].astype(np.uint64), b["word"].astype(np.int64)
        begin = check * CHECK_EVERY
        out = np.zeros((len(b), self.steps - begin, LANES), np.uint32)
        shift, mask = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        words = np.concatenate([self.words, np.zeros(LANES, self.words.dtype)])
        for t in range(self.steps - begin):
            low = x & mask
            s = self.slot[low.astype(np.int64)]
            out[:, t] = self.symbols[s]
            x = self.freq[s] * (x >> shift) + low - self.start[s]
            need = x < LOW
            rank = np.cumsum(need, axis=1)
            word = words[np.minimum(at[:, None] + rank - 1, len(words) - 1)].astype(np.uint64)
            x = np.where(need, (x << np.uint64(32)) | word, x)
            at = at + rank[:, -1]
        n = np.maximum(0, b["ids"].astype(np.int64) - begin * LANES)
        ids = [o[:k] for o, k in zip(out.reshape(len(b), out.shape[1] * LANES), n, strict=True)]
        if not check:
            for i, (o, crc) in enumerate(zip(ids, b["crc32"], strict=True)):
                if zlib.crc32(o.astype("<u4").tobytes()) != crc:
                    raise ValueError(f"block {first + i}: wrong checksum")
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32)


# ---- Spark -----------------------------------------------------------------------------
def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of every row of ``docs`` below ``path``, in ascending
    order of the id."""
    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, encoder = TaskContext.get().partitionId(), Encoder.load(tokenizer)
        end, first = np.uint32(end_id).tobytes(), 0
        ids: list = []
        lens: list[int] = []
        held: list[bytes] = []
        size = 0

        def record() -> pd.DataFrame:
            stream = np.frombuffer(b"".join(held), "<u4")
            row = {"part": part, "first_id": first, "n_ids": len(stream), "doc_ids": list(ids),
                   "doc_lens": list(lens), **encode_segment(stream)}
            return pd.DataFrame({k: [v] for k, v in row.items()})

        for pdf in batches:
            for doc, raw in zip(pdf["doc_id"], encoder.encode(pdf["text"].tolist()), strict=True):
                ids.append(None if pd.isna(doc) else int(doc))
                held.append(raw + end)
                lens.append(len(raw) // 4 + 1)
                size += lens[-1]
                if size >= SEGMENT:
                    yield record()
                    first += size
                    ids, lens, held, size = [], [], [], 0
        if held:
            yield record()

    # a numeric column with nulls would reach pandas as float: ids travel as text
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    (rows.repartitionByRange(F.col("id"), F.xxhash64("text"))
     .sortWithinPartitions(F.col("id"), F.xxhash64("text"))
     .select(F.col("id").cast("string").alias("doc_id"), "text")
     .mapInPandas(segments, RECORD).write.parquet(path))


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``, little-endian 32-bit)
    of every document in the files."""
    files = spark.read.schema(RECORD).parquet(path)
    # one row per written partition
    totals = sorted(files.groupBy("part").agg(F.sum("n_ids")).collect())
    offsets, at = {}, 0
    for part, n in totals:
        offsets[part] = at
        at += n
    sent = spark.sparkContext.broadcast(offsets)
    schema = "doc_id string, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids = Segment(r.bits, r.table, r.blocks, r.states, r.checks, r.words).decode()
                lens = np.array(r.doc_lens, np.int64)
                ends = np.cumsum(lens)
                raw = memoryview(ids.astype("<u4").tobytes())
                cut = [raw[4 * (b - n):4 * b] for b, n in zip(ends.tolist(), lens.tolist(), strict=True)]
                out = {"doc_id": list(r.doc_ids), "start": sent.value[r.part] + r.first_id + ends - lens,
                       "n_tokens": lens, "ids_crc32": [zlib.crc32(c) for c in cut]}
                yield pd.DataFrame(out | ({"ids": [bytes(c) for c in cut]} if with_ids else {}))

    out = files.select("part", "first_id", F.transform("doc_ids", lambda d: d.cast("string"))
                       .alias("doc_ids"), "doc_lens", "bits", "table", "blocks", "states",
                       "checks", "words").mapInPandas(documents, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def tokens(docs: DataFrame, tokenizer: str, with_ids: bool = False, **kw) -> DataFrame:
    """Writes the ids below the shared folder and reads them back."""
    path = f"{work_root(docs.sparkSession, 'tokens')}/ids"
    write_tokens(docs, path, tokenizer, **kw)
    return read_documents(docs.sparkSession, path, with_ids)
