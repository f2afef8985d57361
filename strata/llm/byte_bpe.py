"""Byte-level BPE: ranked merges folded over the distinct words, ids put back into texts, and decoding.

1. Spark's regular expressions split every text into words (matches of the tokenizer's pattern).
2. Each block of 16,384 rows names its distinct words; the distinct words of many blocks are
   encoded by ``fold``: an ``aggregate`` over the word's byte array that starts with single bytes and
   at each step joins the leftmost neighbours of least rank. Ranks come from a literal map of pairs, a hash
   table in one array of numbers; its size is that of the vocabulary file.
3. A block's words and its texts meet in one partition, the words first, and every text is put together from
   their ids there. Texts travel as the places of their words in the block's list, so they are never shuffled; a block's words
   travel as packs of places and ids, some hundred thousand words at a time.
4. Decoding takes each id's bytes and joins the binary pieces of a text.

The fold copies its arrays at each step, so its time grows with the square of a word's length. Words of
over ``LONG`` bytes (runs of one sign, text without blanks) are merged with a heap instead, to the same ids.
"""

from __future__ import annotations

import base64
import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from strata.llm.common import give_back, pick, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Words of more bytes are merged with a heap.
LONG = 512
#: Rows of a block are 2**BLOCK_BITS, cut into parts of about WORDS words where texts are long, up to 2**PART_BITS of them;
#: texts travel PACK at a time, or fewer with over SLICE words.
BLOCK_BITS, PART_BITS, WORDS, PACK, SLICE = 14, 12, 1 << 24, 256, 1_000_000
#: A word is folded once for the blocks of 4096 scan partitions, so that the list of its blocks stays short.
SPAN_BITS = 33 - BLOCK_BITS + PART_BITS + 12


@lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    """{bytes: rank} of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _primes(n: int) -> tuple[int, int]:
    """The first two primes over ``n``."""
    out = []
    while len(out) < 2:
        n += 1
        if all(n % k for k in range(2, int(n ** 0.5) + 1)):
            out.append(n)
    return out[0], out[1]


@lru_cache(4)
def _pair_table(items: tuple) -> tuple[str, int, int, int]:
    """(JSON array, p, q, bits) of the map (left id, right id) -> id of the joined token, its rank.

    A flat array of numbers, as tasks load that far faster than nested maps. Each pair lies in one of two places (cuckoo
    hashing by the remainders of p and q), so a lookup reads two entries, whatever the vocabulary.
    """
    ranks = dict(items)
    bits = max(1, max(ranks.values(), default=0).bit_length())
    if bits > 20:
        raise ValueError("ranks of over 20 bits")
    pairs = {(ranks[w[:i]] << bits) | ranks[w[i:]]: r for w, r in ranks.items() for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks}
    room = max(16, len(pairs) * 11 // 10)
    while True:
        p, q = _primes(room)
        held: list = [None] * (p + q)
        for key in pairs:
            place = key % p
            for _ in range(500):
                key, held[place] = held[place], key
                if key is None:
                    break
                place = p + key % q if place < p else key % p
            if key is not None:
                break
        else:
            return json.dumps([-1 if k is None else (k << bits) | pairs[k] for k in held]), p, q, bits
        room = room * 5 // 4  # a pair found no place


def fold(word, ranks: dict[bytes, int]):
    """Column of ids (array of int) of a column of words: ``aggregate`` over merges of least rank, leftmost first.

    The word's byte array becomes the ids of its single bytes; each step joins two neighbours, whose new id is the
    rank that chose them. Null gives null, an empty word no ids. A word that is a token itself is that token,
    whatever the merges say. Every single byte must be a token.
    """
    table_json, p, q, bits = _pair_table(tuple(ranks.items()))
    literal, mask, none = F.from_json(F.lit(table_json), "array<bigint>"), (1 << bits) - 1, 1 << bits
    last = none << bits
    single = F.array(*[F.lit(ranks[bytes([b])]) for b in range(256)])

    def bind(value, kind, body):  # body(value), the value evaluated once
        return F.aggregate(F.array(value), F.lit(None).cast(kind), lambda _, x: body(x))

    # A part is one number: the rank of its bytes and the next part's (``none`` if they are no token), then its id.
    def part(left, right):
        def rank(k):
            places = F.array((k % p).cast("int"), (k % q + p).cast("int"))
            return F.aggregate(places, F.lit(none).cast("long"), lambda found, i: F.when(
                F.shiftright(F.get(literal, i), bits) == k, F.get(literal, i).bitwiseAND(mask)).otherwise(found))
        return F.shiftleft(bind(F.shiftleft(left, bits) + right, "long", rank), bits) + left

    token = lambda x: x.bitwiseAND(mask)

    def state(parts):  # with the least rank and the place where it is first, in one number
        return bind(parts, kind, lambda x: F.struct(x.alias("parts"), F.array_min(F.transform(x, lambda e, j: e - token(e) + j)).alias("least")))

    def step(s, _):
        def join(new, i):  # parts i and i + 1 become the token ``new``; it and the part before are ranked again
            def after(x, j):
                left = F.when(j == i, new).otherwise(token(x))
                right = F.when(j == i, token(F.get(s["parts"], i + 2))).otherwise(new)
                return F.when((j < i - 1) | (j > i + 1), x).when(j == i + 1, F.lit(None)).when(right.isNull(), last + left).otherwise(part(left, right))
            return state(F.filter(F.transform(s["parts"], after), lambda x: x.isNotNull()))
        return F.when(s["least"] >= last, s).otherwise(join(F.shiftright(s["least"], bits), token(s["least"]).cast("int")))

    kind = "struct<parts:array<bigint>,least:bigint>"
    raw = word.cast("binary")
    size = F.octet_length(raw)
    code = lambda i: F.get(single, F.conv(F.hex(F.substring(raw, i, F.lit(1))), 16, 10).cast("int")).cast("long")
    codes = F.when(size > 0, F.transform(F.sequence(F.lit(1), size), code)).otherwise(F.array().cast("array<bigint>"))
    start = bind(codes, kind, lambda x: state(F.transform(x, lambda a, j: F.when(j + 1 < F.size(x), part(a, F.get(x, j + 1))).otherwise(last + a))))
    turns = F.when(size > 1, F.sequence(F.lit(1), size - 1)).otherwise(F.array().cast("array<int>"))
    merged = F.aggregate(turns, start, step, lambda s: F.transform(s["parts"], lambda x: token(x).cast("int")))
    for w in _missed(tuple(ranks.items())):
        merged = F.when(raw == F.lit(w), F.array(F.lit(ranks[w]))).otherwise(merged)
    return F.when(word.isNotNull(), merged)


@lru_cache(4)
def _missed(items: tuple) -> list[bytes]:
    """Tokens that their own merges do not lead to; none in a vocabulary that was trained by merging."""
    ranks = dict(items)
    return [w for w in ranks if merge_long(w, ranks, False) != [ranks[w]]]


def merge_long(word: bytes, ranks: dict[bytes, int], whole: bool = True) -> list[int]:
    """Ids of one word by the same merges, the next pair found with a heap: for words too long for the fold."""
    if whole and word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)

    def push(i):
        if i >= 0 and after[i] < n and (r := ranks.get(word[i:end[after[i]]])) is not None:
            heapq.heappush(heap, (r, i))

    while heap:
        r, i = heapq.heappop(heap)
        if end[i] < 0 or after[i] >= n or ranks.get(word[i:end[after[i]]]) != r:
            continue  # one of the two was joined since
        j = after[i]
        end[i], after[i], end[j] = end[j], after[j], -1
        if after[i] < n:
            before[after[i]] = i
        push(before[i])
        push(i)
    return [ranks[word[i:end[i]]] for i in range(n) if end[i] >= 0]


@lru_cache(4)
def jvm_pattern(pattern: str) -> str:
    """``pattern`` for the JVM's regular expressions, to the same matches as in the tokenizer's library.

    White space is Unicode's. Letters and numbers newer than the JVM's character tables, which lie in its class of
    code points not assigned, are named one by one: those that the library takes for letters or numbers.
    """
    every = "".join(chr(c) for c in range(0x0221, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.ucd_3_2_0.category(chr(c)) == "Cn")
    bytewise = {bytes([i]): i for i in range(256)}
    out = pattern
    for kind in (r"\p{L}", r"\p{N}"):
        found = tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks=bytewise, special_tokens={}).encode_ordinary(every)
        codes = [ord(c) for c in bytes(found).decode()]
        first = [c for c, b in zip(codes, [-2, *codes]) if c != b + 1]
        last = [c for c, b in zip(codes, [*codes[1:], -2]) if c != b - 1]
        new = "".join(rf"\x{{{a:x}}}-\x{{{z:x}}}" for a, z in zip(first, last))
        out = out.replace(kind, rf"[{kind}[\p{{Cn}}&&[{new}]]]")
    return f"(?U){out}"


def split(text, pattern: str = public_tokenizers.PATTERN):
    """Column of the words (array of string) of a column of texts."""
    return F.regexp_extract_all(text, F.lit(jvm_pattern(pattern)), F.lit(0))


def _number(texts: bool, words: int = WORDS):
    """Of each block of rows (block, key, words): its distinct words in order, or each text's words as places among them.

    ``mark`` is a hash of the words, by which the two agree. A part of a block ends with the row that fills it, so a task
    holds about ``words`` words, or one text.
    """
    def finish(block, keys, parts):
        known = pa.chunked_array([u for u, _ in parts]).unique() if parts else pa.array([], pa.string())
        known = known.take(pc.sort_indices(known))
        mark = xxhash.xxh3_64()
        if len(known):
            _, ends, data = known.buffers()  # just made by ``take``: they begin with the first word
            ends = np.frombuffer(ends, np.int32, len(known) + 1)
            mark.update(ends.tobytes())
            mark.update(memoryview(data)[:ends[-1]])
        block, mark = [block], mark.intdigest() >> 1
        if not texts:
            for i in range(0, len(known), 100_000):
                n = min(100_000, len(known) - i)
                marks = pa.array([mark if i == 0 else None] + [None] * (n - 1), pa.int64())  # once, on the first word
                yield pa.RecordBatch.from_arrays([pa.array(block * n, pa.int64()), marks, pa.array(np.arange(i, i + n, dtype=np.int32)), known.slice(i, n)],
                                                 names=["block", "mark", "place", "word"])
            return
        pack = zstandard.ZstdCompressor(level=3)
        for key, (unique, lists) in zip(keys, parts):
            place = pc.index_in(unique, value_set=known).to_numpy()
            at, ends = place[lists.values.to_numpy()].astype(np.int32) if len(unique) else np.zeros(0, np.int32), lists.offsets.to_numpy()
            i = 0
            while i < len(key):  # some hundred texts a row, which pack better than one by one
                j = min(i + PACK, max(i + 1, int(np.searchsorted(ends, ends[i] + SLICE, "right")) - 1))
                sink = pa.BufferOutputStream()  # keys of any type, as bytes: list columns are slow to write row by row
                part = pa.RecordBatch.from_arrays([key.slice(i, j - i)], names=["key"])
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int64()), pa.array([mark], pa.int64()), pa.array([True]), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                     pa.array([np.diff(ends[i:j + 1]).astype(np.int32).tobytes()], pa.binary()), pa.array([pack.compress(at[ends[i]:ends[j]].tobytes())], pa.binary())],
                    names=["block", "mark", "is_text", "keys", "sizes", "places"])
                i = j

    def run(batches):
        block, keys, parts, whole, seen = None, [], [], None, 0
        for b in batches:
            if not b.num_rows:
                continue
            rows, sizes = b.column("block").to_numpy(), pc.list_value_length(b.column("words")).to_numpy()
            # words of the block before each row: those of earlier batches, if it began there, and of earlier rows
            before = np.cumsum(sizes) - sizes
            first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            start = np.repeat(before[first], np.diff([*first, len(rows)]))
            before = before - start + np.where(rows == whole, seen, 0)
            blocks = (rows << PART_BITS) + np.minimum(before // words, (1 << PART_BITS) - 1)
            whole, seen = rows[-1], int(before[-1] + sizes[-1])
            cuts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
            for a, z in zip(cuts, [*cuts[1:], b.num_rows]):
                if blocks[a] != block:
                    yield from finish(block, keys, parts)
                    block, keys, parts = int(blocks[a]), [], []
                    give_back()
                lists = b.column("words").slice(a, z - a)
                coded = lists.flatten().dictionary_encode()
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
                parts.append((coded.dictionary, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), coded.indices) if texts else None))
                keys.append(b.column("key").slice(a, z - a) if texts else None)
        yield from finish(block, keys, parts)
    return run


_STABLE = "a block's words are not those of its texts: the rows must come from a stable scan"


def _deal(ranks: dict[bytes, int]):
    """Words' ids for their blocks: of some words at a time one row a block, with their places in order and their ids, packed.

    Words that come without ids are the long ones, which are merged here, once for all of their blocks.
    """
    def packs(held):
        t = pa.Table.from_batches(held).combine_chunks()
        at, ids = t.column("at").chunk(0), t.column("ids").chunk(0)
        if ids.null_count:
            ids = pa.array([merge_long(w.encode(), ranks) if i is None else i for w, i in zip(t.column("word").to_pylist(), ids.to_pylist())], ids.type)
        flat, owner = at.flatten(), pc.list_parent_indices(at).to_numpy()
        block, place, mark = flat.field("block").to_numpy(), flat.field("place").to_numpy(), flat.field("mark")
        order = np.lexsort((place, block))
        cuts = np.flatnonzero(np.concatenate([[True], block[order][1:] != block[order][:-1]]))
        pack = zstandard.ZstdCompressor(level=3)
        for a, z in zip(cuts, [*cuts[1:], len(order)]):
            rows = order[a:z]
            part, marks = ids.take(pa.array(owner[rows])), pc.unique(mark.take(pa.array(rows)).drop_null()).to_pylist()
            if len(marks) > 1:
                raise ValueError(_STABLE)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block[order[a]]], pa.int64()), pa.array(marks or [None], pa.int64()), pa.array([False]),
                 *(pa.array([pack.compress(x.astype(np.int32).tobytes())], pa.binary()) for x in (place[rows], pc.list_value_length(part).to_numpy(), part.flatten().to_numpy()))],
                names=["block", "mark", "is_text", "keys", "sizes", "places"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += len(b.column("at").flatten())
            if n >= SLICE:
                yield from packs(held)
                held, n = [], 0
                give_back()
        if held:
            yield from packs(held)
    return run


def _assemble(batches):
    """Ids of each text. A block's words come before its texts."""
    unpack = zstandard.ZstdDecompressor()
    numbers = lambda raw: np.frombuffer(unpack.decompress(raw.as_py()), np.int32)

    def lists(packs):  # the block's words in order, each with its ids
        if not packs:
            return pa.array([], pa.list_(pa.int32()))
        place, sizes, ids = (np.concatenate(x) for x in zip(*packs))
        order = np.argsort(place)
        if not np.array_equal(place[order], np.arange(len(place))):
            raise ValueError(_STABLE)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids)).take(pa.array(order))

    block, marks, packs, known = None, set(), [], None
    for b in batches:
        give_back()
        blocks, is_text, mark = b.column("block").to_pylist(), b.column("is_text").to_pylist(), b.column("mark").to_pylist()
        for i in range(b.num_rows):
            if blocks[i] != block:
                block, marks, packs, known = blocks[i], set(), [], None
            if mark[i] is not None:
                marks.add(mark[i])
            if not is_text[i]:
                packs.append([numbers(b.column(n)[i]) for n in ("keys", "sizes", "places")])
                continue
            if len(marks) > 1:
                raise ValueError(_STABLE)
            if known is None:
                known, packs = lists(packs), []
            got = known.take(pa.array(numbers(b.column("places")[i])))
            words = np.concatenate([[0], np.cumsum(np.frombuffer(b.column("sizes")[i].as_py(), np.int32))])
            keys = pa.ipc.open_stream(b.column("keys")[i].as_py()).read_all().column(0).combine_chunks()
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(got).to_numpy())])[words]
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), got.flatten())], names=["key", "ids"])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, key: str = "doc_id", long: int = LONG,
           part_words: int = WORDS) -> DataFrame:
    """(``key``, ids array<int>) of every row of ``docs``, which has ``key`` and text.

    A null or empty text has no ids; repeated rows and null keys are rows like others; ties of rank go to the
    leftmost pair; an empty table gives none; other columns are not read. ``docs`` must be a stable scan, which is
    read twice and whose blocks then hold the same rows; if they do not, the job fails.
    """
    rows = pick(docs, key, "text").select(
        F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("block"), F.col(f"`{key}`").alias("key"),
        split(F.coalesce("text", F.lit("")), pattern).alias("words"))
    of = rows.schema["key"].dataType
    words = rows.mapInArrow(_number(False, part_words), "block long, mark long, place int, word string")
    words = words.withColumn("span", F.shiftright("block", SPAN_BITS)).repartition("word", "span")  # so the groups need no other shuffle
    merged = words.groupBy("word", "span").agg(F.collect_list(F.struct("block", "mark", "place")).alias("at")).withColumn(
        "ids", F.when(F.octet_length("word") <= long, fold(F.col("word"), ranks)))
    packs = StructType([*(StructField(n, LongType()) for n in ("block", "mark")), StructField("is_text", BooleanType()),
                        *(StructField(n, BinaryType()) for n in ("keys", "sizes", "places"))])
    known = merged.select("at", F.when(F.col("ids").isNull(), F.col("word")).alias("word"), "ids").mapInArrow(_deal(ranks), packs)
    texts = rows.mapInArrow(_number(True, part_words), packs)
    dealt = known.union(texts).repartition("block").sortWithinPartitions("block", "is_text")
    return dealt.mapInArrow(_assemble, StructType([StructField("key", of), StructField("ids", ArrayType(IntegerType()))])).withColumnRenamed("key", key)


def decode(coded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``coded`` with ``into``: the bytes (binary) that each row's ``ids`` stand for, their pieces joined in order.

    Null gives null, no ids the empty string of bytes; an id without a piece is an error. Other columns stay; one that is
    named ``into`` is replaced.
    """
    pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token

    def run(batches):
        known = pa.array(pieces, pa.binary())
        for b in batches:
            lists = b.column(ids)
            sizes = np.cumsum(np.concatenate([[0], pc.fill_null(pc.list_value_length(lists), 0).to_numpy()]))
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(sizes, sizes[i] + SLICE, "right")) - 1)
                part = lists.slice(i, j - i)
                flat = part.flatten()
                odd = pc.or_(pc.less(flat, 0), pc.greater_equal(flat, len(pieces)))
                if pc.any(odd).as_py():
                    raise ValueError(f"no token has the id {flat.filter(odd)[0]}")
                got = known.take(flat)
                if got.null_count:
                    raise ValueError(f"no token has the id {flat.filter(got.is_null())[0]}")
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(sizes[i:j + 1] - sizes[i], pa.int32()), got), b"")
                joined = pc.if_else(pc.is_valid(part), joined, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*(b.column(n).slice(i, j - i) for n in kept), joined], names=[*kept, into])
                i = j

    kept = [n for n in coded.columns if n != into]
    return coded.mapInArrow(run, StructType([*(coded.schema[n] for n in kept), StructField(into, BinaryType())]))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    coded = encode(table(spark, sf_dir, "documents"), ranks)
    return decode(coded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
