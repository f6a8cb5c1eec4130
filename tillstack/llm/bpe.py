"""Byte-level BPE encoding and decoding (operator 7).

A text's matches of the split pattern are words; each is encoded by itself, so
only distinct words are.  Their bytes, as an array of one-byte strings, are
folded by Spark's higher-order functions: the ranks of all neighbours are looked up
in a literal rank map, every step joins the pair of the lowest rank (the leftmost
of equal ones) and looks up its two new neighbours, until no pair has a rank.  The literal is an array of small maps
dealt by the pieces' hash, because a map's lookup is a scan.  Decoding
concatenates the binary pieces of the ids.

Words reach the documents again by blocks: a block holds the different words of
some documents once and, for each document, the numbers of its words (frequent
words have small numbers, so they compress well).  Words that have a rank of
their own need no fold.  The others are dealt into shares by a hash, each block's
part of a share packed, and a share's different words get their places (block,
number), at most one for each block; the word is folded and its ids go back to the
blocks, packed for each block and task.  A row holds a word's places in about
``WORD_PLACES`` blocks; a word that more blocks have is folded once for each such
row.  The text moves not at all, nor do the blocks, which are stored in buckets.

Words of over ``LONG`` bytes (the fold's work grows with the square of a word's
length) are encoded by the tiktoken library's merge of single pieces instead.

Edge cases: null and empty texts have no ids and decode to nothing; repeated
rows each give a row; a null id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tokenizers import Regex, pre_tokenizers

from tillstack.llm.common import bucketed, give_back, small_batches, stored

BLOCK_WORDS, LONG, BUCKETS = 1 << 21, 256, 1 << 16
#: About so many places of one word are in a row; so many places are packed together.
WORD_PLACES, PACK_PLACES = 4096, 1 << 17
#: About so many places of words are gathered together; a word counts once more for each so many bytes.
SHARE_PLACES, WORD_BYTES = 1 << 18, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a piece and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def jvm_pattern(pattern: str) -> str:
    """The split pattern for Java, whose own white space is ASCII only."""
    return pattern.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


def split_words(text: Column, pattern: str = public_tokenizers.PATTERN) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(jvm_pattern(pattern)), F.lit(0))


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The literal rank map: pieces (strings of one sign for each byte) and their ranks, as small maps."""
    maps: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        signs = piece.decode("latin-1")
        maps[xxhash.xxh64_intdigest(signs.encode(), seed=42) % BUCKETS][signs] = rank
    return F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,int>>")


def _once(value: Column, then) -> Column:
    """``then(value)``, in which the value is computed, or the literal stands, once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def fold_merges(word: Column, table: Column) -> Column:
    """The ids of one word: array<int>.  The expression, and with it every task, holds the table once."""
    signs = F.decode(word.cast("binary"), "ISO-8859-1")
    return _once(table, lambda t: _fold(signs, lambda piece: F.element_at(
        F.get(t, F.xxhash64(piece).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), piece)))


def _fold(signs: Column, rank) -> Column:
    """The fold over an array of pieces, each with the rank of the pair that it begins."""
    pieces = F.split(signs, "")
    n = F.size(pieces)

    def entry(piece: Column, pair: Column) -> Column:
        return F.struct(piece.alias("p"), pair.alias("r"))

    def joined_at(a: Column, at: Column, new: Column) -> Column:
        """The pieces after a merge: only the two pairs beside the new piece have other ranks."""
        before, after = F.get(a, at - 2).p, F.get(a, at + 1).p
        left = F.when(at > 1, F.concat(F.slice(a, 1, at - 2), F.array(entry(before, rank(F.concat(before, new)))))).otherwise(
            F.array().cast("array<struct<p:string,r:int>>"))
        return F.concat(left, F.array(entry(new, rank(F.concat(new, after)))), F.slice(a, at + 2, F.size(a)))

    def merge(a: Column, _: Column) -> Column:
        return _once(F.array_position(a.r, F.array_min(a.r)).cast("int"), lambda at: F.when(at.isNull(), a).otherwise(
            _once(F.concat(F.get(a, at - 1).p, F.get(a, at).p), lambda new: joined_at(a, at, new))))

    start = F.transform(pieces, lambda p, i: entry(p, F.when(i + 1 < n, rank(F.concat(p, F.get(pieces, i + 1))))))
    folded = F.aggregate(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), start, merge)
    return F.coalesce(F.when(rank(signs).isNotNull(), F.array(rank(signs))), F.transform(folded, lambda e: rank(e.p)))


def word_blocks(docs: DataFrame, ranks: dict[bytes, int], text: str, id_col: str) -> DataFrame:
    """``(block, load, words, ids, sizes, own, index)``: how many different words without a
    rank a block has (long ones count more), these words, its documents' ids and numbers of
    words, all its words' ranks (-1 for none), and the words' numbers, one after another."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType

    def split(words: pa.Array, odd: pa.Array) -> pa.Array:
        if odd.null_count == len(odd):
            return words
        by = pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated")
        return pa.array([w if t is None else [x for x, _ in by.pre_tokenize_str(t)] for w, t in zip(words.to_pylist(), odd.to_pylist())],
                        pa.list_(pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def made() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in held])
            sizes = np.concatenate([h[1] for h in held]).astype("<i4")
            coded = pa.chunked_array([h[2] for h in held]).unify_dictionaries().combine_chunks()
            index = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(-np.bincount(index, minlength=len(coded.dictionary)), kind="stable")  # frequent words first
            number = np.empty(len(order), "<u4")
            number[order] = np.arange(len(order))
            words = coded.dictionary.take(pa.array(order)) if len(order) else pa.array([], pa.string())
            own = [ranks.get(w.encode(), -1) for w in words.to_pylist()]
            planes = np.ascontiguousarray(number[index].view(np.uint8).reshape(-1, 4).T)  # the bytes of one place side by side
            parts = [sizes.tobytes(), np.array(own, "<i4").tobytes(), planes.tobytes()]
            name = xxhash.xxh64(repr(ids.to_pylist()).encode())
            for part in (*parts, *(w.encode() for w in words.to_pylist())):
                name.update(part)
            asked = words.filter(pa.array([x < 0 for x in own], pa.bool_()))
            return pa.RecordBatch.from_arrays(
                [pa.array([name.intdigest() - (1 << 63)]), pa.array([len(asked) + (pc.sum(pc.binary_length(asked)).as_py() or 0) // WORD_BYTES]), pa.ListArray.from_arrays(pa.array([0, len(asked)], pa.int32()), asked),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 *(pa.array([zstandard.compress(x)], pa.binary()) for x in parts)], ["block", "load", "words", "ids", "sizes", "own", "index"])

        for b in batches:
            words = split(b.column(1), b.column(2))
            sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
            start = 0
            for r in range(b.num_rows):
                count += int(sizes[r])
                if count >= BLOCK_WORDS or r == b.num_rows - 1:
                    part = words.slice(start, r + 1 - start)
                    held.append((b.column(0).slice(start, r + 1 - start), sizes[start:r + 1], part.flatten().dictionary_encode()))
                    start = r + 1
                    if count >= BLOCK_WORDS:
                        full = made()
                        held, count = [], 0
                        yield full
                        give_back()
        if held:
            full = made()
            held = []
            yield full
        give_back()

    whole = F.col(text).cast("string")
    # a text with signs that this JVM's Unicode does not know yet is split by the tokenizers library, which agrees with tiktoken
    odd = F.coalesce(whole.rlike(r"\p{Cn}"), F.lit(False))
    return docs.select(F.col(id_col).alias("id"), F.when(odd, F.array().cast("array<string>")).otherwise(split_words(whole)).alias("words"),
                       F.when(odd, whole).alias("odd")).mapInArrow(
        run, f"block long, load long, words array<string>, ids array<{id_type.simpleString()}>, sizes binary, own binary, index binary")


def encode_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``words`` (different words in a column ``word``) with ``tokens``, their ids; null for long words."""
    return words.withColumn("tokens", F.when(F.octet_length("word") <= LONG, fold_merges(F.col("word"), rank_table(ranks))))


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers, the bytes of one place side by side: they compress well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _dealt(shares: int):
    """Blocks' words (``block, words``) dealt by a hash: ``(block, share, packed)`` with the words' numbers and the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                words = [w.encode() for w in b.column(1)[r].as_py()]
                of = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % shares
                order = np.argsort(of, kind="stable")
                cut = np.searchsorted(of[order], np.arange(shares + 1))
                names, out = [], []
                for share in np.flatnonzero(np.diff(cut)).tolist():
                    j = order[cut[share]:cut[share + 1]]
                    mine = [words[i] for i in j.tolist()]
                    head = np.array([len(j)], "<u4").tobytes()
                    lengths = np.fromiter(map(len, mine), np.int64, len(mine))
                    names.append(share)
                    out.append(zstandard.compress(head + _planes(np.diff(j, prepend=0)) + _planes(lengths) + b"".join(mine)))
                yield pa.RecordBatch.from_arrays([pa.repeat(b.column(0)[r], len(out)), pa.array(names, pa.int32()), pa.array(out, pa.binary())],
                                                 ["block", "share", "packed"])
        give_back()

    return run


def _gathered(share: pa.Table) -> pa.Table:
    """A share's different words, each with its places."""
    blocks, numbers, words = [], [], []
    for block, packed in zip(share["block"].to_pylist(), share["packed"].to_pylist()):
        data = zstandard.decompress(packed)
        n = int.from_bytes(data[:4], "little")
        j, lengths = (np.ascontiguousarray(x.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
                      for x in np.split(np.frombuffer(data, np.uint8, 8 * n, 4), 2))
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        words.append(pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(data[4 + 8 * n:])))
        numbers.append(np.cumsum(j))
        blocks.append(np.full(n, block, np.int64))
    coded = pa.concat_arrays(words).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(index, kind="stable")
    ends = np.cumsum(np.bincount(index, minlength=len(coded.dictionary)))
    places = pa.StructArray.from_arrays([pa.array(np.concatenate(blocks)[order]), pa.array(np.concatenate(numbers)[order], pa.int32())], ["block", "j"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), places)
    by_word = pc.sort_indices(coded.dictionary)  # neighbours compress well
    return pa.table([coded.dictionary.take(by_word), lists.take(by_word)], names=["word", "places"])


def gather_words(blocks: DataFrame) -> DataFrame:
    """``(word, places)``: the different words of ``word_blocks`` without a rank, each with
    the blocks that hold it and its number there, a row for some ``WORD_PLACES`` blocks."""
    n, load = blocks.agg(F.count(F.lit(1)), F.sum("load")).first()
    parts = max(1, -(-n // WORD_PLACES))
    shares = max(1, -(-(load or 0) // (parts * SHARE_PLACES)))
    dealt = blocks.select("block", "words").mapInArrow(_dealt(shares), "block long, share int, packed binary")
    return (dealt.groupBy("share", F.pmod("block", F.lit(parts)).alias("part"))
            .applyInArrow(_gathered, "word string, places array<struct<block:bigint,j:int>>"))


def _packed(ranks: dict[bytes, int]):
    """Words' places, ids and, if they have none yet, the words themselves, gathered for each
    block: ``(of_block, packed)`` with the words' numbers in the block, their numbers of ids, and the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = None
        held, count = [], 0

        def coded(b: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal merges
            places, tokens, left = b.columns
            if left.null_count < len(left):  # long words: merged here, so that a task needs one Python worker
                merges = merges or tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
                tokens = pa.array([t if w is None else merges.encode_ordinary(w) for t, w in zip(tokens.to_pylist(), left.to_pylist())],
                                  pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([places, tokens], ["places", "tokens"])

        def made() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            places, tokens = t.column(0).combine_chunks(), t.column(1).combine_chunks()
            flat = places.flatten()
            block, j = (c.to_numpy(zero_copy_only=False) for c in flat.flatten())
            word = np.repeat(np.arange(len(t)), pc.list_value_length(places).to_numpy(zero_copy_only=False))
            lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
            ids, begin = tokens.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths) - lengths
            order = np.lexsort((j, block))
            block, j, word = block[order], j[order], word[order]
            cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
            out = []
            for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
                n = lengths[word[s:e]]
                of = np.arange(n.sum()) + np.repeat(begin[word[s:e]] - (np.cumsum(n) - n), n)
                head = np.array([e - s], "<u4").tobytes()
                out.append(zstandard.compress(head + _planes(np.diff(j[s:e], prepend=0)) + _planes(n) + _planes(ids[of])))
            return pa.RecordBatch.from_arrays([pa.array(block[cut[:-1]]), pa.array(out, pa.binary())], ["of_block", "packed"])

        for b in batches:
            if b.num_rows:
                held.append(coded(b))
                count += len(b.column(0).flatten())
            if count >= PACK_PLACES:
                yield made()
                held.clear()
                count = 0
        if held:
            yield made()
        give_back()

    return run


def _unpacked(packed: pa.ChunkedArray) -> tuple[np.ndarray, pa.ListArray]:
    """The words' numbers and their ids."""
    numbers, lengths, ids = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
    for v in packed.to_pylist():
        data = zstandard.decompress(v)
        n = int.from_bytes(data[:4], "little")
        rows = np.frombuffer(data, np.uint8, offset=4)
        j, size, tokens = (np.ascontiguousarray(x.reshape(4, -1).T).view("<u4").ravel() for x in np.split(rows, [4 * n, 8 * n]))
        numbers.append(np.cumsum(j.astype(np.int64)))
        lengths.append(size.astype(np.int64))
        ids.append(tokens)
    offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths))))
    return np.concatenate(numbers), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids), pa.uint32()))


def encode(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", id_col: str = "doc_id", decoded: str | None = None) -> DataFrame:
    """``(id, tokens)`` for each row; tokens are little-endian unsigned 32-bit integers.
    With ``decoded`` a column of that name has what the tokens decode to, joined in the
    same task (``decode`` does it in a further Python worker)."""
    pieces = piece_list(ranks) if decoded else []
    id_type = docs.schema[id_col].dataType
    blocks = bucketed(word_blocks(docs, ranks, text, id_col), "word-blocks", "block")
    words = stored(gather_words(blocks), "words")
    found = (encode_words(words, ranks).select("places", "tokens", F.when(F.octet_length("word") > LONG, F.col("word")).alias("word"))
             .mapInArrow(_packed(ranks), "of_block long, packed binary"))

    def whole(block: pa.Table, coded: pa.Table) -> pa.Table:
        number, lists = _unpacked(coded["packed"])
        lists = lists.take(pa.array(np.unique(number, return_index=True)[1]))  # blocks that repeat have their words twice
        ids, out = [], []
        for r in range(len(block)):
            sizes, own, planes = (np.frombuffer(zstandard.decompress(block[c][r].as_py()), kind)
                                  for c, kind in (("sizes", "<i4"), ("own", "<i4"), ("index", np.uint8)))
            index = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
            lengths = np.ones(len(own), np.int64)
            lengths[own < 0] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            begin = np.cumsum(lengths) - lengths
            flat = np.empty(lengths.sum(), "<u4")
            flat[begin[own >= 0]] = own[own >= 0]
            flat[np.repeat(own < 0, lengths)] = lists.flatten().to_numpy(zero_copy_only=False)
            at = 0
            for size in sizes.tolist():
                some = index[at:at + size]
                n = lengths[some]
                out.append(flat[np.arange(n.sum()) + np.repeat(begin[some] - (np.cumsum(n) - n), n)].tobytes())
                at += size
            ids.append(block["ids"][r].values)
        columns = [pa.concat_arrays(ids), pa.array(out, pa.binary())]
        if decoded:
            columns.append(pa.array([joined(pieces, t) for t in out], pa.binary()))
        return pa.table(columns, names=names)

    names = ["id", "tokens", *([decoded] if decoded else [])]
    return blocks.drop("words", "load").groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(
        whole, StructType([StructField("id", id_type), *(StructField(c, BinaryType()) for c in names[1:])]))


def piece_list(ranks: dict[bytes, int]) -> list[bytes]:
    """The piece of each rank."""
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def joined(pieces: list[bytes], tokens: bytes) -> bytes:
    """What tokens decode to."""
    return b"".join([pieces[i] for i in np.frombuffer(tokens, "<u4").tolist()])


def decode(coded: DataFrame, ranks: dict[bytes, int], tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """``coded`` with ``into``, the concatenated pieces of the ids."""
    pieces = piece_list(ranks)
    at = coded.columns.index(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [joined(pieces, v.as_py() or b"") for v in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], [*b.schema.names, into])

    return coded.mapInArrow(run, StructType([*coded.schema.fields, StructField(into, BinaryType())]))


def op7_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The digest of the operator: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ranks = read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode(docs, ranks, decoded="decoded").select(
        F.col("id").alias("doc_id"), (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
