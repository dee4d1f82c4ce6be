"""Best-fit packing of tokenised documents, improved by swap-based local search.

Pieces shorter than a sequence are dealt into blocks by a hash. A block is packed
best-fit decreasing, and then documents are moved, exchanged one for one or two for
one between underfull bins. Each step raises the sum of squared fills, so the
fullest bins fill up and the emptiest run empty. Bins that stay underfull are
opened again, and their pieces are packed with those of other blocks."""

from __future__ import annotations

import itertools
import math
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import textbytes as tb
from mercato.llm.registry import register, table
from mercato.llm.scratch import Scratch
from mercato.llm.shipping import map_arrow, ship

SEQUENCE_TOKENS = 2048
END_TOKEN = 0
BLOCK_PIECES = 20_000
# Bytes of words and parts whose ids a worker remembers before it starts anew, with what
# each entry takes besides.
REMEMBERED_BYTES = 128 << 20
ENTRY_BYTES = 200
# Texts tokenised at once; the words of a longer one are read one by one.
TEXT_BYTES = 1 << 19
# From this fill on a bin is left alone between rounds.
GOOD_FILL = 0.995
# Rounds go on as long as one settles this share of the pieces that were open.
WORTH_A_ROUND = 0.05


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# A space, which is in no word, ends one.
ASCII_PARTS = re.compile(CONTRACTIONS + r"|[a-z]+|[0-9]|[^\sa-z0-9]+| ")
PARTS = regex.compile(CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+| ")
BREAK = -1
END_OF_PART = "</w>"
WORDS = re.compile(rb"[^ \t-\r]+")
END_OF_TEXT = np.zeros(1, np.int64)


class Numbers(defaultdict):
    """Numbers 1, 2, ... given to keys when first asked for."""

    def __init__(self):
        super().__init__(itertools.count(1).__next__)
        self.listed, self.held = 0, 0

    def new(self) -> list:
        """The keys since the last call, in the order of their numbers."""
        keys = list(itertools.islice(reversed(self), len(self) - self.listed))[::-1]
        self.listed = len(self)
        self.held += sum(map(len, keys)) + ENTRY_BYTES * len(keys)
        return keys


class Lists:
    """Numbered lists of whole numbers, looked up many at once."""

    def __init__(self, first: list[int]):
        self.lengths, self.starts = np.array([len(first)], np.int64), np.zeros(1, np.int64)
        self.flat = np.array(first, np.int32)

    def add(self, lengths: np.ndarray, flat: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])

    def expand(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists one after the other, and where each begins (one entry more)."""
        lengths = self.lengths[numbers]
        upto = np.concatenate(([0], np.cumsum(lengths)))
        return self.flat[np.repeat(self.starts[numbers] - upto[:-1], lengths) + np.arange(upto[-1])], upto


class WordIds:
    """Token ids of texts. The vocabulary drops white space and ends tokens there, so a
    text's ids are those of its words, and a word's those of its parts: runs of
    letters, digits and runs of others. The tokenizer sees each new part once; a word
    with characters out of the ordinary is one part, which it cuts itself."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary)
        ends = [i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(END_OF_PART)]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[ends] = True
        self.restart()

    def restart(self) -> None:
        # Word 0 and part 0 are the end of a document.
        self.words, self.parts = Numbers(), Numbers()
        self.parts[" "] = BREAK
        self.parts.new()
        self.parts_of_words, self.ids_of_parts = Lists([0]), Lists([END_TOKEN])

    def _cut(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of words, and how many each word has."""
        ascii_words = [w.isascii() for w in words]
        numbers, counts = [], np.zeros(len(words), np.int64)
        for is_ascii in (True, False):
            at = [i for i, a in enumerate(ascii_words) if a is is_ascii]
            if not at:
                continue
            flat = self._parts_of([words[i] for i in at], is_ascii)
            found = np.fromiter(map(self.parts.__getitem__, flat), np.int64, len(flat))
            breaks = np.flatnonzero(found == BREAK)
            counts[at] = np.diff(breaks, prepend=-1) - 1
            numbers.append((np.array(at), found[found != BREAK]))
        if len(numbers) == 1:
            return numbers[0][1], counts
        out, upto = np.empty(int(counts.sum()), np.int64), np.cumsum(counts) - counts
        for at, found in numbers:
            own = counts[at]
            out[np.repeat(upto[at] - (np.cumsum(own) - own), own) + np.arange(len(found))] = found
        return out, counts

    def _parts_of(self, words: list[bytes], is_ascii: bool) -> list[str | bytes]:
        """The parts of the words, one word after the other, a space behind each."""
        text = b" ".join(words).decode()
        if text.isprintable() and "<|" not in text:
            text = text.lower() if is_ascii else self.tokenizer.normalizer.normalize_str(text)
            flat = (ASCII_PARTS if is_ascii else PARTS).findall(text + " ")
            if flat.count(" ") == len(words):
                return flat
        if len(words) == 1:
            return [words[0], " "]  # as bytes, so that it is no ordinary part
        half = len(words) // 2
        return self._parts_of(words[:half], is_ascii) + self._parts_of(words[half:], is_ascii)

    def _learn(self) -> None:
        words = self.words.new()
        if not words:
            return
        numbers, counts = self._cut(words)
        self.parts_of_words.add(counts, numbers)
        parts = self.parts.new()
        if not parts:
            return
        plain = [x for x in parts if isinstance(x, str)]
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.int64)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(plain):
            raise ValueError("this vocabulary does not end a token with each part")
        lengths = np.diff(last, prepend=-1)
        if len(plain) == len(parts):
            self.ids_of_parts.add(lengths, ids)
            return
        at = iter(np.split(ids, last[:-1] + 1) if len(plain) else [])
        lists = [
            next(at)
            if isinstance(x, str)
            else np.array(self.tokenizer.encode(x.decode(), add_special_tokens=False).ids, np.int64)
            for x in parts
        ]
        self.ids_of_parts.add(np.array([len(x) for x in lists], np.int64), np.concatenate(lists))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each with its end token, and where each text begins."""
        if self.words.held + self.parts.held > REMEMBERED_BYTES:
            self.restart()
        numbers: list[np.ndarray] = []
        ends = [0]
        for text in texts:
            words = text.split() if len(text) <= TEXT_BYTES else (m[0] for m in WORDS.finditer(text))
            numbers += [np.fromiter(map(self.words.__getitem__, words), np.int64), END_OF_TEXT]
            ends.append(ends[-1] + len(numbers[-2]) + 1)
        self._learn()
        parts, word_at = self.parts_of_words.expand(np.concatenate(numbers) if numbers else END_OF_TEXT[:0])
        ids, part_at = self.ids_of_parts.expand(parts)
        return ids, part_at[word_at[ends]]


_known: dict[str, WordIds] = {}


def word_ids(vocabulary: str) -> WordIds:
    """The worker's own. The tokenizer is kept from task to task, the words are not."""
    if vocabulary not in _known:
        _known[vocabulary] = WordIds(vocabulary)
    return _known[vocabulary]


def tokenised_pieces(documents: DataFrame, vocabulary: str, tokens: int = SEQUENCE_TOKENS, with_ids: bool = True) -> DataFrame:
    """`doc_id`, `piece`, `start`, `length`, `ids_crc32` and, if asked for, `ids`
    (little-endian unsigned 32-bit) of `documents`."""
    fields = [("doc_id", documents.schema["doc_id"].dataType.simpleString()), ("piece", "int"), ("start", "bigint")]
    fields += [("length", "bigint"), ("ids_crc32", "bigint")] + [("ids", "binary")] * with_ids
    schema = ", ".join(f"{n} {t}" for n, t in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(vocabulary)
        try:
            for batch in batches:
                doc_ids = batch.column(batch.schema.get_field_index("doc_id"))
                for part in tb.slices(batch.column(batch.schema.get_field_index("text")), TEXT_BYTES):
                    data = part.data.tobytes()
                    ids, begin = words.encode([data[a:b] for a, b in zip(part.offsets[:-1], part.offsets[1:])])
                    pieces = -(-np.diff(begin) // tokens)
                    row = np.repeat(np.arange(len(part)), pieces)
                    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                    first = begin[row] + piece * tokens
                    last = np.minimum(first + tokens, begin[row + 1])
                    raw = ids.astype("<u4").tobytes()
                    blobs = [raw[4 * a : 4 * b] for a, b in zip(first, last)]
                    columns = [doc_ids.take(pa.array(part.first + row)), pa.array(piece, pa.int32()), pa.array(piece * tokens)]
                    columns += [pa.array(last - first), pa.array([zlib.crc32(x) for x in blobs], pa.int64())]
                    columns += [pa.array(blobs, pa.binary())] * with_ids
                    yield pa.RecordBatch.from_arrays(columns, [n for n, _ in fields])
        finally:
            words.restart()

    return map_arrow(documents.select("doc_id", "text"), run, schema)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of item numbers, best-fit decreasing. Open bins are kept by what is left."""
    bins: list[list[int]] = []
    by_rest: list[list[int]] = [[] for _ in range(size + 1)]
    rests = 0  # bit r is set if a bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = rests >> need
        if fitting:
            rest = need + (fitting & -fitting).bit_length() - 1
            b = by_rest[rest].pop()
            if not by_rest[rest]:
                rests &= ~(1 << rest)
            bins[b].append(i)
        else:
            b, rest = len(bins), size
            bins.append([i])
        rest -= need
        if rest:
            by_rest[rest].append(b)
            rests |= 1 << rest
    return bins


class Offers:
    """What underfull bins could take, by the length it would take: the free space of a
    bin, alone or with one or two of its items given back. Items of equal length are
    alike, so a bin has at most as many offers as pairs of different lengths. Offers of
    one `limit` are ordered by what is given back; a bin that is `out` has none left."""

    def __init__(self, size: int, bins: list[dict[int, int]], fill: list[int], order: list[int]):
        limits, backs, owners, firsts = [], [], [], []
        for b in order:
            rest = size - fill[b]
            kinds = np.array(sorted(bins[b]), np.int64)
            twice = kinds[[bins[b][k] > 1 for k in kinds.tolist()]]
            i, j = np.triu_indices(len(kinds), 1)
            first = np.concatenate(([0], kinds, kinds[i], twice))
            back = first + np.concatenate(([0], np.zeros(len(kinds), np.int64), kinds[j], twice))
            limits.append(rest + back)
            backs.append(back)
            firsts.append(first)
            owners.append(np.full(len(back), b))
        limit, back = np.concatenate(limits), np.concatenate(backs)
        by = np.lexsort((back, limit))
        self.back, self.first = back[by].tolist(), np.concatenate(firsts)[by].tolist()
        self.owner = np.concatenate(owners)[by].tolist()
        cuts = np.searchsorted(limit[by], np.arange(size + 2))
        self.at, self.end = cuts[:-1].tolist(), cuts[1:].tolist()
        self.none = size + 1
        # The least that is given back in any offer of a limit.
        self.least = np.full(size + 1, self.none, np.int64)
        some = np.flatnonzero(np.diff(cuts))
        self.least[some] = back[by][cuts[some]]

    def find(self, need: int, out: list[bool]) -> tuple[int, int, list[int]] | None:
        """Bin, limit and given lengths of the tightest offer that takes an item of
        `need` for less; None if there is none."""
        while True:
            good = self.least[need:] < need
            k = int(good.argmax())
            if not good[k]:
                return None
            limit = need + k
            at, end = self.at[limit], self.end[limit]
            while at < end and out[self.owner[at]]:
                at += 1
            self.at[limit] = at
            self.least[limit] = self.back[at] if at < end else self.none
            if at < end and self.back[at] < need:
                first, back = self.first[at], self.back[at]
                return self.owner[at], limit, [x for x in (first, back - first) if x]


def local_search(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """Take items from the emptiest bins and put them into fuller ones: into the space
    left there (move), or in exchange for one or two items that are shorter together.
    The fuller bin gains, so the sum of squared fills rises with each step, and the
    search ends. A pass goes through all underfull bins, from the emptiest on, and tries
    each length in it against all offers of the fuller ones; a bin that has gained waits
    for the next pass. It ends when a pass changes nothing."""
    length = lengths.tolist()
    held: list[dict[int, int]] = []
    for b in bins:
        kinds: dict[int, int] = {}
        for i in b:
            kinds[length[i]] = kinds.get(length[i], 0) + 1
        held.append(kinds)
    fill = [sum(length[i] for i in b) for b in bins]

    def take(b: int, kind: int) -> None:
        held[b][kind] -= 1
        if not held[b][kind]:
            del held[b][kind]

    changed = True
    while changed:
        changed = False
        order = sorted((b for b in range(len(bins)) if 0 < fill[b] < size), key=lambda b: fill[b])
        if len(order) < 2:
            break
        offers = Offers(size, held, fill, order)
        out = [False] * len(bins)
        for b in order:
            if out[b]:
                continue
            out[b] = True
            for need in sorted(held[b], reverse=True):
                while held[b].get(need) and (found := offers.find(need, out)):
                    c, _, given = found
                    take(b, need)
                    for kind in given:
                        take(c, kind)
                        held[b][kind] = held[b].get(kind, 0) + 1
                    held[c][need] = held[c].get(need, 0) + 1
                    fill[c] += need - sum(given)
                    fill[b] -= need - sum(given)
                    out[c] = changed = True
    # Items of one length are alike: they are dealt out by number.
    items: dict[int, list[int]] = {}
    for i in range(len(length) - 1, -1, -1):
        items.setdefault(length[i], []).append(i)
    return [[items[kind].pop() for kind in sorted(b, reverse=True) for _ in range(b[kind])] for b in held if b]


def pack(lengths: np.ndarray, size: int) -> list[list[int]]:
    return local_search(best_fit(lengths, size), lengths, size)


def _block_packer(tokens: int, first_block: int, final: bool):
    def run(group):
        group = group.sort_by("pid")
        number = group.column("block")[0].as_py()
        lengths = group.column("length").to_numpy()
        bins = pack(lengths, tokens)
        order = np.array([i for b in bins for i in b], np.int64)
        sizes = np.array([len(b) for b in bins])
        bin_of = np.repeat(np.arange(len(bins)), sizes)
        ordered = lengths[order]
        upto = np.cumsum(ordered) - ordered
        offset = upto - np.repeat(upto[np.cumsum(sizes) - sizes], sizes)
        fills = np.bincount(bin_of, ordered)
        settled = (fills >= GOOD_FILL * tokens)[bin_of] | final
        ids = -(1 + bin_of + ((first_block + number) << 26))
        pids = group.column("pid").to_numpy()[order]
        return pa.table({"pid": pids, "length": ordered, "sequence_id": ids, "offset": offset, "settled": settled})

    return run


def placed_pieces(pieces: DataFrame, scratch: Scratch, tokens: int = SEQUENCE_TOKENS, block: int = BLOCK_PIECES) -> DataFrame:
    """`pid`, `sequence_id`, `offset` for `pid`, `length`. Pieces of a whole sequence
    are one each. Blocks have about `block` pieces, whatever the input; a round deals
    the pieces of underfull bins anew, until a round settles few of them."""
    spark = pieces.sparkSession
    ship(spark)
    done = [
        pieces.where(F.col("length") == tokens).select("pid", F.col("pid").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    ]
    open_pieces = pieces.where(F.col("length") < tokens).select("pid", "length")
    used, before, round_number = 0, None, 0
    while n := open_pieces.count():
        blocks = max(1, math.ceil(n / block))
        final = blocks == 1 or before is not None and n > (1 - WORTH_A_ROUND) * before
        salted = open_pieces.withColumn("block", F.pmod(F.xxhash64("pid", F.lit(round_number)), F.lit(blocks)))
        packed = scratch.write(
            salted.repartition(blocks, "block").groupBy("block").applyInArrow(
                _block_packer(tokens, used, final), "pid bigint, length bigint, sequence_id bigint, offset bigint, settled boolean"
            ),
            f"packed{round_number}",
        )
        done.append(packed.where("settled").select("pid", "sequence_id", "offset"))
        open_pieces = packed.where("not settled").select("pid", "length")
        used, before, round_number = used + blocks, n, round_number + 1
        if final:
            break
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionAll(more)
    return placed


def pack_documents(
    documents: DataFrame,
    vocabulary: str | None = None,
    tokens: int = SEQUENCE_TOKENS,
    with_ids: bool = True,
    block: int = BLOCK_PIECES,
) -> DataFrame:
    """One row for each piece of `documents`: `doc_id`, `piece`, `start`, `length`,
    `ids_crc32`, with `with_ids` also `ids`, and its `sequence_id` and `offset`.

    A document is its token ids and the id 0. One longer than a sequence is cut into
    pieces of `tokens`, the last may be shorter; others stay whole. A null or empty
    text is the single id 0. Repeated rows, and rows without doc_id, are packed each
    for themselves. An empty table gives an empty result; other columns are not
    read. Blocks make sure that no task packs more than about `block` pieces; a
    block leaves less than one bin for each `GOOD_FILL` share in later rounds."""
    scratch = Scratch(documents.sparkSession, "packing")
    pieces = scratch.write(
        tokenised_pieces(documents, vocabulary or default_vocabulary(), tokens, with_ids).withColumn(
            "pid", F.monotonically_increasing_id()
        ),
        "pieces",
    )
    return pieces.join(placed_pieces(pieces, scratch, tokens, block), "pid").drop("pid")


@register("op2_packing")
def op2_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), with_ids=False)
