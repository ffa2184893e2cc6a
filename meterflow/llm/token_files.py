"""Token ids in an entropy-coded binary format: static range asymmetric numeral systems (rANS).

One table of frequencies serves the whole corpus. Documents, in ascending id order, are packed into blocks
that never cut a document; each block is coded on its own by interleaved 64-bit states that put out 32-bit
words. Every ``STEPS`` steps a checkpoint holds the states and the place in the words, so a reader may start
there; each such segment has a checksum over its ids and each block one over its words. Blocks are rows of a
Parquet table in the shared folder: Spark commits and splits them, so lost executors cost one task.

Null text counts as empty and gives the end id alone; documents without id come first; repeated ids are
ordered by their checksum; other columns of the input are ignored.
"""

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.tables import new_folder, ragged, slices, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SCALE_BITS = 20
LANES = 512
STEPS = 128
BLOCK_TOKENS = 1 << 17
CACHED_WORDS, CACHED_PIECES = 100_000, 300_000
PIECES_AT_ONCE = 1000
#: More text at once holds fewer distinct words in all.
BYTES_AT_ONCE = 1 << 21
#: How the tokenizer splits words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LOWEST = np.uint64(1 << 31)
WORD = np.uint64(32)

ENCODED = "doc_id long, n_tokens long, ids_crc32 long, ids binary"
BLOCK = ("part int, block int, first long, doc_ids array<long>, counts array<long>, lanes int, words binary, words_crc32 long, "
         "states array<binary>, places array<long>, segment_crc32 array<long>")
BLOCK_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("counts", pa.list_(pa.int64())), ("lanes", pa.int32()), ("words", pa.binary()), ("words_crc32", pa.int64()),
    ("states", pa.list_(pa.binary())), ("places", pa.list_(pa.int64())), ("segment_crc32", pa.list_(pa.int64()))])


class _Numbers(defaultdict):
    """Gives every new key the next number."""

    def __init__(self):
        super().__init__(count().__next__)

    def of(self, keys: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The numbers of the keys, and the keys that are new, in the order of their numbers."""
        distinct, before = keys.dictionary_encode(), len(self)
        own = distinct.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.__getitem__, own), np.int64, len(own))
        return numbers[distinct.indices.to_numpy()], distinct.dictionary.filter(pa.array(numbers >= before))


class _Runs:
    """Runs of ids by their numbers."""

    def __init__(self):
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.known, self.used = np.zeros(4096, np.uint16), 0, 0

    def add(self, flat: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> None:
        """The next runs, in a row; order: which of the next numbers each of them has."""
        known, used = self.known + len(lengths), self.used + len(flat)
        while len(self.starts) < known:
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while len(self.ids) < used:
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.starts[self.known + order] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.known + order] = lengths
        self.ids[self.used:used] = flat
        self.known, self.used = known, used

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the runs ``at`` in a row, and the number of ids of each."""
        lengths = self.lengths[at]
        return self.ids[ragged(self.starts[at], lengths)], lengths


class WordCoder:
    """Ids of white-space separated words, each distinct word looked up and each distinct piece tokenised once.

    The tokenizer drops white space and never joins across it, so a text has the ids of its words in a row. Nor does it join
    across the pieces that ``SPLIT`` makes of a word. Pieces are tokenised many at a time, with blanks between them, and told
    apart by the tokens that end one; those of ASCII alone need no normaliser. A word that holds other than ASCII and
    letters is tokenised by itself, as is every word where the tokenizer splits in another way. ASCII lower-casing first is
    what its normaliser does anyway, save in texts that hold a special token. A cache is emptied when full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        about = json.loads(self.tokenizer.to_str())
        self.special = "|".join(re.escape(x["content"]) for x in about["added_tokens"])
        last = about["model"].get("end_of_word_suffix")
        split, *then = (about["pre_tokenizer"] or {}).get("pretokenizers", [None])
        self.splits = bool(last) and split == {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
        if self.splits:
            self.ends = np.zeros(1 << 16, bool)  # tokens that end a piece
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(last)]] = True
            blanks = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *then]}
            self.plain = Tokenizer.from_str(json.dumps(about | {"normalizer": None, "pre_tokenizer": blanks, "added_tokens": []}))
        self.words, self.word_ids = _Numbers(), _Runs()
        self.pieces, self.piece_ids = _Numbers(), _Runs()

    def clear(self) -> None:
        if len(self.words) > CACHED_WORDS:
            self.words, self.word_ids = _Numbers(), _Runs()
        if len(self.pieces) > CACHED_PIECES:
            self.pieces, self.piece_ids = _Numbers(), _Runs()

    def _tokenised(self, texts: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        ids = [x.ids for x in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint16, int(lengths.sum())), lengths

    def _joined(self, pieces: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces of letters or of other ASCII."""
        ids, _ = self._tokenised([" ".join(pieces)], tokenizer)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(pieces) or last[-1] != len(ids) - 1:  # the tokenizer takes other signs for letters
            return self._tokenised(pieces)
        return ids, np.diff(last, prepend=-1)

    def _whole(self, words: pa.Array) -> np.ndarray:
        """Which words are to be tokenised by themselves."""
        if not self.splits:
            return np.ones(len(words), bool)
        whole = pc.invert(pc.match_substring_regex(words, r"^(?:[[:ascii:]]|\p{L})*$"))
        if self.special:
            whole = pc.or_(whole, pc.match_substring_regex(words, self.special))
        return whole.to_numpy(zero_copy_only=False)

    def add(self, words: pa.Array) -> None:
        whole = self._whole(words)
        plain = np.flatnonzero(~whole)
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(words.take(pa.array(plain))), SPLIT, r"\0 "))
        at, new = self.pieces.of(lists.flatten())
        if len(new):
            by_kind = np.where(pc.binary_length(new).to_numpy() == 0, 2, 1 - pc.string_is_ascii(new).to_numpy(zero_copy_only=False))
            order, coded = np.argsort(by_kind, kind="stable"), [self._tokenised([""])] * int((by_kind == 2).sum())
            for kind, tokenizer in ((1, self.tokenizer), (0, self.plain)):
                own = new.take(pa.array(np.flatnonzero(by_kind == kind))).to_pylist()
                coded[:0] = [self._joined(own[i:i + PIECES_AT_ONCE], tokenizer) for i in range(0, len(own), PIECES_AT_ONCE)]
            self.piece_ids.add(*map(np.concatenate, zip(*coded)), order)
        ids, lengths = self.piece_ids.of(at)
        counts = np.diff(np.concatenate(([0], np.cumsum(lengths)))[lists.offsets.to_numpy()])
        lone = np.flatnonzero(whole)
        lone_ids, lone_counts = self._tokenised([x.decode(errors="replace") for x in words.take(pa.array(lone)).cast(pa.binary()).to_pylist()])
        self.word_ids.add(np.concatenate((ids, lone_ids)), np.concatenate((counts, lone_counts)), np.concatenate((plain, lone)))

    def code(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text."""
        self.clear()
        texts = pc.fill_null(texts, "")
        low = pc.ascii_lower(texts)
        if self.special:
            low = pc.if_else(pc.match_substring_regex(low, self.special, ignore_case=True), texts, low)
        split = pc.ascii_split_whitespace(low)
        at, new = self.words.of(split.flatten())
        if len(new):
            self.add(new)
        ids, lengths = self.word_ids.of(at)
        ends = np.concatenate(([0], np.cumsum(lengths)))[split.offsets.to_numpy()]
        return ids, np.diff(ends)


_CODERS: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    """One coder for all tasks of a Python worker."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 and the ids as 16-bit little-endian numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(tokenizer)
        for batch in slices(batches, most=BYTES_AT_ONCE):
            ids, counts = words.code(batch.column("text"))
            parts = [np.append(x, np.uint16(end_id)) for x in np.split(ids, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts + 1), pa.array([crc_of(x) for x in parts], pa.int64()),
                 pa.array([x.astype("<u2").tobytes() for x in parts], pa.binary())],
                ["doc_id", "n_tokens", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ENCODED)


def frequencies(encoded: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of every id over the whole corpus, scaled to sum to 2 ** SCALE_BITS, none of them 0."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(vocabulary, np.int64)
        for batch in batches:
            ids = b"".join(batch.column("ids").to_pylist())
            seen += np.bincount(np.frombuffer(ids, "<u2"), minlength=vocabulary)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["id", "n"])

    counts = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    seen = np.zeros(vocabulary, np.int64)
    for row in counts.collect():  # one row for each id of the vocabulary at most
        seen[row.id] = row.n
    total, room = max(1, int(seen.sum())), (1 << SCALE_BITS) - vocabulary
    scaled = np.array([1 + int(n) * room // total for n in seen], np.int64)
    scaled[int(scaled.argmax())] += (1 << SCALE_BITS) - int(scaled.sum())
    return scaled


def code_block(ids: np.ndarray, scaled: np.ndarray, below: np.ndarray) -> dict:
    """Code ids back to front, so that a reader goes front to back; lane i holds ids i, i + lanes, ..."""
    lanes = min(LANES, len(ids))
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, LOWEST)
    freq, low = scaled[ids].astype(np.uint64), below[ids].astype(np.uint64)
    shift, bits = np.uint64(63 - SCALE_BITS), np.uint64(SCALE_BITS)
    chunks: list[np.ndarray] = []
    states: list[bytes] = []
    emitted: list[int] = []
    for step in range(steps - 1, -1, -1):
        f, c = freq[step * lanes:(step + 1) * lanes], low[step * lanes:(step + 1) * lanes]
        now = state[:len(f)]
        full = now >= f << shift
        chunks.append(now[full].astype("<u4"))
        now = np.where(full, now >> WORD, now)
        state[:len(f)] = ((now // f) << bits) + now % f + c
        emitted.append(len(chunks[-1]))
        if step % STEPS == 0:
            states.append(state.astype("<u8").tobytes())
    words = np.concatenate(chunks[::-1])
    places = np.concatenate(([0], np.cumsum(emitted[::-1])))[:-1][::STEPS]
    payload = words.tobytes()
    return {"lanes": lanes, "words": payload, "words_crc32": zlib.crc32(payload), "states": states[::-1], "places": places.tolist(),
            "segment_crc32": [crc_of(ids[i:i + STEPS * lanes]) for i in range(0, len(ids), STEPS * lanes)]}


def decode_segment(words: np.ndarray, state: bytes, place: int, n: int, scaled: np.ndarray, below: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The ``n`` ids from a checkpoint on; independent of every other segment."""
    now = np.frombuffer(state, "<u8").astype(np.uint64)
    lanes, bits, mask = len(now), np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
    out = np.empty(n, np.uint16)
    for at in range(0, n, lanes):
        x = now[:min(lanes, n - at)]
        slot = x & mask
        ids = symbol[slot]
        out[at:at + lanes] = ids
        x = scaled[ids] * (x >> bits) + slot - below[ids]
        dry = np.flatnonzero(x < LOWEST)
        x[dry] = (x[dry] << WORD) | words[place:place + len(dry)]
        place += len(dry)
        now[:len(x)] = x
    return out


def write_blocks(encoded: DataFrame, scaled: np.ndarray, path: str) -> None:
    """Blocks in ascending document order; the order of partitions is the order of ids."""
    below = np.cumsum(scaled) - scaled

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids: list[bytes] = []
        docs: list[int | None] = []
        counts: list[int] = []
        block = first = held = 0

        def close() -> pa.RecordBatch:
            coded = code_block(np.frombuffer(b"".join(ids), "<u2"), scaled, below)
            row = {"part": part, "block": block, "first": first, "doc_ids": docs, "counts": counts} | coded
            return pa.RecordBatch.from_pylist([row], schema=BLOCK_SCHEMA)

        for batch in batches:
            for doc, n, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))):
                ids.append(own)
                docs.append(doc)
                counts.append(n)
                held += n
                if held >= BLOCK_TOKENS:
                    yield close()
                    block, first, held = block + 1, first + held, 0
                    ids, docs, counts = [], [], []
        if docs:
            yield close()

    order = ["doc_id", "ids_crc32"]
    placed = encoded.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.select("doc_id", "n_tokens", "ids").mapInArrow(pack, BLOCK).write.parquet(path)


def read_blocks(spark, path: str, scaled: np.ndarray, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids, decoded from the files and held against their checksums."""
    freq, below = scaled.astype(np.uint64), (np.cumsum(scaled) - scaled).astype(np.uint64)

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol = np.repeat(np.arange(len(freq), dtype=np.uint16), freq.astype(np.int64))
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                if zlib.crc32(row["words"]) != row["words_crc32"]:
                    raise ValueError(f"block {row['part']}/{row['block']}: the words are damaged")
                words, n = np.frombuffer(row["words"], "<u4").astype(np.uint64), sum(row["counts"])
                size, parts = STEPS * row["lanes"], []
                for i, (state, place, crc) in enumerate(zip(row["states"], row["places"], row["segment_crc32"])):
                    parts.append(decode_segment(words, state, place, min(size, n - i * size), freq, below, symbol))
                    if crc_of(parts[-1]) != crc:
                        raise ValueError(f"block {row['part']}/{row['block']}, segment {i}: the ids are damaged")
                ids, counts = np.concatenate(parts), np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                own = np.split(ids, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(np.full(len(counts), row["part"], np.int32)),
                     pa.array(row["first"] + ends - counts), pa.array(counts), pa.array([crc_of(x) for x in own], pa.int64()),
                     pa.array([x.astype("<u2").tobytes() if with_ids else b"" for x in own], pa.binary())],
                    ["doc_id", "part", "inside", "n_tokens", "ids_crc32", "ids"])

    blocks = spark.read.parquet(path)
    docs = blocks.mapInArrow(unpack, "doc_id long, part int, inside long, n_tokens long, ids_crc32 long, ids binary")
    sizes = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition that was written
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return docs.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_files(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Tokenise whole texts, write the files, and read them back."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    encoded = written(encode(docs, tokenizer, end_id), "token-ids")
    scaled = frequencies(encoded, Tokenizer.from_file(tokenizer).get_vocab_size())
    path = new_folder(spark, "token-blocks")
    write_blocks(encoded, scaled, path)
    return read_blocks(spark, path, scaled, with_ids)
