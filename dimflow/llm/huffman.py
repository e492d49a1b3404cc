"""Token ids written as canonical, length-limited Huffman codes, and read back.

One code for all files comes from counts over the whole corpus. A dataset is a folder: ``codebook`` holds the code
length of every id (a canonical code is its lengths), ``blocks`` holds rows of whole documents in ascending document
order, numbered by part and block. A block is decoded without any other: its payload starts at bit 0, and checkpoints
hold the bit offset of every 64th id, so a reader can start at any of them; the decoder starts at all of them at once and
takes one id per step in each lane from a table over the next bits. Both tables are Parquet, so they are committed by
Spark as a whole and lie on any file system that Spark reaches.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from dimflow.llm.common import binary_array, kept, no_collector, pieces_of, stored

#: Longest code in bits, ids between two checkpoints, ids aimed for in a block and in a part.
LONGEST, STEP, BLOCK_IDS, PART_IDS = 18, 64, 1 << 16, 1 << 22
#: Words a worker remembers, and the longest worth it (characters); bytes of texts that are encoded together.
MEMORY, REMEMBERED, TOGETHER = 600_000, 64, 1 << 22

#: Type codes of packed ids by their bytes.
WIDTHS = {2: "H", 4: "I"}

#: The normalizer and the pattern of the vocabulary whose words are cut into pieces here.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: The same pattern for a lowered ASCII word.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+")


def width_of(vocabulary: int) -> int:
    """Bytes that an id takes while it is on its way to a file."""
    return 2 if vocabulary <= 1 << 16 else 4


class WordEncoder:
    """Encodes texts with a tokenizer that never joins characters across white space, a word at a time.

    The texts of a batch are cut into words and their distinct words found by Arrow; those that are not known yet are learned
    together. If the tokenizer has the normalizer and the pattern of this vocabulary, an unknown word is cut into the
    pattern's pieces here and its pieces are remembered as well; the tokenizer's model encodes a piece. Else, and for words
    of other scripts' signs, the tokenizer encodes the word.
    """

    def __init__(self, tokenizer_json: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json.decode())
        self.model = self.tokenizer.model
        self.code = WIDTHS[width_of(self.tokenizer.get_vocab_size())]
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("added tokens must be matched in the text as it is, wherever they are")
        self.added = {t.content: array(self.code, [i]).tobytes() for i, t in added.items()}
        form = json.loads(tokenizer_json)
        self.own_pieces = (form["normalizer"], form["pre_tokenizer"]) == (_NORMALIZER, _PRE_TOKENIZER)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def packed(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned integers of the encoder's width; texts may be null."""
        if texts.null_count:
            found, given = [b""] * len(texts), pc.indices_nonzero(texts.is_valid())
            for i, ids in zip(given.to_pylist(), self.packed(texts.take(given)), strict=True):
                found[i] = ids
            return found
        for token in self.added:
            if pc.any(pc.match_substring(texts, token)).as_py():  # white space changes nothing around it
                texts = pc.replace_substring(texts, token, f" {token} ")
        lists = pc.ascii_split_whitespace(texts)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        distinct = lists.flatten().dictionary_encode()
        coded = self._coded(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
        width = array(self.code).itemsize
        ids = np.frombuffer(b"".join(coded), f"<u{width}")
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // width
        places = np.cumsum(sizes) - sizes
        words = distinct.indices.to_numpy()
        counts = sizes[words]
        done = np.concatenate([[0], np.cumsum(counts)])
        flat = ids[np.repeat(places[words] - done[:-1], counts) + np.arange(done[-1])].tobytes()
        bounds = (done[ends] * width).tolist()
        return [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _coded(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words; an empty word has none."""
        if len(self.young) > MEMORY:
            self.young, self.old = {}, self.young
        missing = set(words).difference(self.young)
        if missing:
            self._learn(missing)
        coded = list(map(self.young.__getitem__, words))
        for word in missing:
            if len(word) > REMEMBERED:
                del self.young[word]
        return coded

    def _learn(self, words: set[str]) -> None:
        young, old, pieces = self.young, self.old, self.pieces
        if "" in words:
            young[""] = b""
        for word in words & self.added.keys():
            young[word] = self.added[word]
        for word in words & old.keys():
            young[word] = old[word]
        new = [w for w in words if w not in young]
        if not self.own_pieces:
            self._by_tokenizer(new, young)
            return
        if len(pieces) > MEMORY:
            pieces.clear()
        several: dict[str, list[str]] = {}
        single: dict[str, str] = {}
        other = [w for w in new if not w.isascii() and len(w.split()) != 1]  # with white space beyond ASCII
        if other:
            new = list(set(new).difference(other))
        for word, plain in zip(new, self._normal(new), strict=True):
            if plain.isalpha():
                single[word] = plain
            elif plain.isascii():
                several[word] = _ASCII_PIECES.findall(plain)
            elif plain[:-1].isalpha() and plain[-1] in ".,!?:;":
                several[word] = [plain[:-1], plain[-1]]
            else:
                other.append(word)
        needed = set(single.values()).union(*several.values()) - pieces.keys()
        for piece in needed:
            spelled = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(_BYTE_SIGNS)
            pieces[piece] = array(self.code, [token.id for token in self.model.tokenize(spelled)]).tobytes()
        for word, plain in single.items():
            young[word] = pieces[plain]
        for word, parts in several.items():
            young[word] = b"".join([pieces[p] for p in parts])
        self._by_tokenizer(other, young)
        for piece in needed:
            if len(piece) > REMEMBERED:
                del pieces[piece]

    def _normal(self, words: list[str]) -> list[str]:
        """Words as the normalizer gives them: ASCII is lowered by any rule, the others are normalized together."""
        found = [w.lower() if w.isascii() else "" for w in words]
        others = [i for i, w in enumerate(found) if not w]
        if others:
            normalize = self.tokenizer.normalizer.normalize_str
            together = normalize(" ".join([words[i] for i in others])).split(" ")
            if len(together) != len(others):
                together = [normalize(words[i]) for i in others]
            for i, plain in zip(others, together, strict=True):
                found[i] = plain
        return found

    def _by_tokenizer(self, words: list[str], into: dict[str, bytes]) -> None:
        for word, coded in zip(words, self.tokenizer.encode_batch(words, add_special_tokens=False), strict=True):
            into[word] = array(self.code, coded.ids).tobytes()


def _byte_signs() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from 256."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in prints)}


_BYTE_SIGNS = _byte_signs()

def _encoder(shared) -> WordEncoder:
    return kept(("words", hash(shared.value)), lambda: WordEncoder(shared.value))


def tokenize(docs: DataFrame, tokenizer: str, *, end_id: int, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the whole text's ids and ``end_id`` as packed little-endian integers, of 16 bits where the vocabulary
    allows, else of 32. Null and empty texts have the end only; a column named like ``ids`` is replaced.

    The tokenizer's file is read on the driver and broadcast; a vocabulary has a fixed size (here below 2 MB).
    """
    with open(tokenizer, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.arrow_udf("binary")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared)
        end = array(encoder.code, [end_id]).tobytes()
        for batch in batches:
            with no_collector():
                found = [ids for texts in pieces_of(batch, TOGETHER) for ids in encoder.packed(texts)]
            yield binary_array([ids + end for ids in found])

    return docs.withColumn(ids, to_ids(F.col(text)))


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits by package-merge; 0 for ids that never occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids do not fit codes of {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = packages = counts[order].astype(np.int64)
    levels = [np.ones(len(leaves), bool)]
    for _ in range(longest - 1):
        even = len(packages) // 2 * 2
        packages = np.concatenate([leaves, packages[0:even:2] + packages[1:even:2]])
        by_weight = np.argsort(packages, kind="stable")
        packages = packages[by_weight]
        levels.append(by_weight < len(leaves))
    taken = 2 * len(leaves) - 2
    for leaf in reversed(levels):
        own = int(leaf[:taken].sum())
        lengths[order[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


class Code:
    """The canonical code of given lengths: codes of a length are consecutive in order of ids."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.longest = int(lengths.max(initial=1))
        used = np.flatnonzero(lengths)
        self.order = used[np.lexsort((used, lengths[used]))]
        steps = np.left_shift(1, self.longest - self.lengths[self.order])
        starts = np.cumsum(steps) - steps
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[self.order] = starts >> (self.longest - self.lengths[self.order])
        #: For every ``longest`` bits the id that they begin with.
        self.table = np.zeros(1 << self.longest, np.uint32)
        self.table[: int(steps.sum())] = np.repeat(self.order, steps)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The payload and the bit offset of every ``STEP``-th id."""
        sizes = self.lengths[ids]
        if len(ids) and not sizes.min():
            raise ValueError("an id without a code")
        ends = np.cumsum(sizes)
        begins = ends - sizes
        word, bit = begins >> 5, (begins & 31)
        wide = self.codes[ids] << (64 - sizes - bit).astype(np.uint64)  # a code touches two words of 32 bits at most
        words = np.zeros((int(ends[-1]) >> 5) + 2 if len(ids) else 2, np.uint64)
        if len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] += np.add.reduceat(wide >> np.uint64(32), first)
            words[word[first] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), first)
        payload = words.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8 if len(ids) else 0]
        return payload, begins[::STEP].astype(np.uint32)

    def decode(self, payload: bytes, n: int, checkpoints: np.ndarray) -> np.ndarray:
        """``n`` ids; every checkpoint is a lane, and each step decodes one id in all lanes."""
        data = np.frombuffer(payload + b"\0" * 4, np.uint8).astype(np.uint32)
        windows = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        at, out = checkpoints.astype(np.int64), np.zeros((STEP, len(checkpoints)), np.uint32)
        last, shift, mask = len(windows) - 1, 32 - self.longest, (1 << self.longest) - 1
        for step in range(min(STEP, n)):
            bits = windows[np.minimum(at >> 3, last)] >> (shift - (at & 7)).astype(np.uint32) & np.uint32(mask)
            out[step] = found = self.table[bits]
            at += self.lengths[found]
        return out.T.reshape(-1)[:n]


def count_ids(tokens: DataFrame, ids: str = "ids", width: int = 4) -> np.ndarray:
    """How often each id occurs. Tasks count, Spark adds up; one row per id of the vocabulary reaches the driver."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            ids = b"".join(blob.as_py() for blob in batch.column(0) if blob.is_valid)
            more = np.bincount(np.frombuffer(ids, f"<u{width}"))
            if len(more) > len(counts):
                counts, more = more, counts
            counts[: len(more)] += more
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["id", "n"])

    found = tokens.select(ids).mapInArrow(tally, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((row["id"] for row in found), default=0) + 1, np.int64)
    for row in found:
        counts[row["id"]] = row["n"]
    return counts


BLOCKS = "part int, block int, n_ids long, doc_ids array<long>, doc_lengths array<long>, checkpoints binary, payload binary"


def write(tokens: DataFrame, path: str, *, width: int, key: str = "doc_id", ids: str = "ids") -> None:
    """Write rows of an integer key and ids packed in ``width`` bytes below ``path`` in ascending order of the key, null first.

    Rows that repeat a key are ordered by a checksum of their ids. Documents are never split over blocks, so a very long
    one makes a longer block. An empty table gives an empty dataset.
    """
    spark = tokens.sparkSession
    counts = count_ids(tokens, ids, width)
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast(lengths)
    parts = max(1, -(-int(counts.sum()) // PART_IDS))

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part, block = Code(shared.value), TaskContext.get().partitionId(), 0
        keys, arrays, size = [], [], 0

        def flush() -> pa.RecordBatch:
            payload, checkpoints = code.encode(np.concatenate(arrays))
            row = {
                "part": part, "block": block, "n_ids": size, "doc_ids": keys, "doc_lengths": list(map(len, arrays)),
                "checkpoints": checkpoints.astype("<u4").tobytes(), "payload": payload,
            }
            return pa.RecordBatch.from_pylist([row], schema=block_schema)

        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(k)
                arrays.append(np.frombuffer(blob.as_buffer(), f"<u{width}") if blob.is_valid else np.zeros(0, np.uint16))
                size += len(arrays[-1])
                if size >= BLOCK_IDS:
                    yield flush()
                    keys, arrays, size, block = [], [], 0, block + 1
        if keys:
            yield flush()

    block_schema = pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
         ("doc_lengths", pa.list_(pa.int64())), ("checkpoints", pa.binary()), ("payload", pa.binary())]
    )
    slim = tokens.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"), F.crc32(ids).alias("sum"))
    ordered = slim.repartitionByRange(parts, "key", "sum").sortWithinPartitions("key", "sum")
    ordered.select("key", "ids").mapInArrow(to_blocks, BLOCKS).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written dataset: key, ids packed in 32 bits, their number and ``start``, the ids of all documents before.

    Where a block starts comes from the blocks' sizes alone; those numbers, a few bytes per block, meet the blocks before
    they are decoded.
    """
    lengths = np.frombuffer(spark.read.parquet(f"{path}/codebook").first()["lengths"], np.uint8)
    shared = spark.sparkContext.broadcast(lengths)

    def to_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                before, n, keys, sizes, checkpoints, payload = (batch.column(c)[i] for c in range(6))
                decoded = code.decode(payload.as_py(), n.as_py(), np.frombuffer(checkpoints.as_buffer(), "<u4")).astype("<u4")
                sizes = np.array(sizes.as_py(), np.int64)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array(before.as_py() + ends - sizes), pa.array(sizes),
                     binary_array([decoded[a:b].tobytes() for a, b in zip(ends - sizes, ends, strict=True)])],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    def running(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("n_ids").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))  # one row per written file
    parts = parts.select(F.col("part").alias("p"), running(Window.orderBy("part")).alias("before_part"))
    inside = blocks.select("part", "block", running(Window.partitionBy("part").orderBy("block")).alias("before_block"))
    starts = inside.join(parts, F.col("part") == F.col("p")).select(
        "p", F.col("block").alias("b"), (F.col("before_part") + F.col("before_block")).alias("before")
    )
    starts = stored(starts, "starts")
    placed = blocks.join(starts, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b")))
    placed = placed.select("before", "n_ids", "doc_ids", "doc_lengths", "checkpoints", "payload")
    return placed.mapInArrow(to_docs, "doc_id long, start long, n_tokens long, ids binary")
