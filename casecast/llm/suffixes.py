"""Removal of passages that an earlier document holds, by merging sorted runs of suffixes."""

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecast.llm.common import DOC_ID, TEXT, in_small_batches, row_key, text_or_empty

#: Bytes of text whose suffixes make one sorted run, and bytes of text for each part of the key space.
RUN_BYTES, BUCKET_BYTES = 16 << 20, 16 << 20
#: Bytes of text that are searched for anchors at once, few enough for a core's cache; longer texts are cut into
#: overlapping parts.
PART_BYTES = 1 << 17
#: The filter that is broadcast has a bit for about FILTER_BYTES bytes of text, and 2^FILTER_BITS bits (64 MB) at most.
#: It is made in at least SLICES slices, and in one for about SLICE_BYTES of text.
FILTER_BITS, FILTER_BYTES = 29, 8
SLICES, SLICE_BYTES = 16, 64 << 20
#: Runs of one task are numbered from its partition number times this.
TASK_RUNS = 1 << 24
NO_ID = np.iinfo(np.int64).max

#: A gram around which at least so many different texts lie, and at least one in CROWD_SHARE of all anchors, is crowded:
#: its strings are dealt out one by one. At most MOST_CROWDED are, and counts start at CROWD_LOCAL texts in a run.
CROWD, CROWD_SHARE, MOST_CROWDED, CROWD_LOCAL = 5_000, 200_000, 100_000, 4
CROWDS = -1  # the slice number under which they travel

LOCAL = "bucket int, run bigint, kind int, blob binary"
SUFFIXES, PIECES, COVERED = 0, 1, 2
CUT = (
    T.StructType()
    .add("kept", T.BinaryType())
    .add("n_bytes", T.LongType())
    .add("n_removed", T.LongType())
    .add("n_spans", T.LongType())
    .add("spans", T.ArrayType(T.LongType()))
)


def _packed(*arrays, level=1):
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(arrays, protocol=5))


def _unpacked(blob):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


class Shape:
    """What follows from the length of the strings that count as repeated."""

    def __init__(self, width):
        if width < 16:
            raise ValueError("width is at least 16 bytes")
        self.width = width
        self.gram = width // 16 * 8
        self.span = width - self.gram + 1  # grams in a string of that length
        self.text = width + self.span - 1
        self.row = self.text + 2


def _mixed(words):
    """One 64-bit hash for the words of each row."""
    value = np.full(words[0].shape, 0x9E3779B97F4A7C15, np.uint64)
    room = np.empty_like(value)
    for word in words:
        value ^= word
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= np.right_shift(value, np.uint64(31), out=room)
    value *= np.uint64(0x94D049BB133111EB)
    value ^= np.right_shift(value, np.uint64(29), out=room)
    return value


def anchors(data, ends, shape):
    """First and last start, gram position and gram hash of the groups of neighbouring strings that share their least gram.

    `data` holds pieces of text one after the other, which end at `ends`. A string of `width` bytes is represented by
    its gram of the least hash (the leftmost of equals), which depends on its own bytes only: equal strings have equal
    grams at equal offsets. Neighbouring strings mostly share it, so there is one anchor for about `span`/2 strings.
    """
    n = len(data)
    if n < shape.width:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    grams = n - shape.gram + 1
    words = np.ndarray((n - 7,), "<u8", data, 0, (1,)).copy()
    hashes = _mixed([words[offset : offset + grams] for offset in range(0, shape.gram, 8)])
    low = np.uint64((1 << 24) - 1)
    least = (hashes & ~low) | np.arange(grams, dtype=np.uint64)
    reach = 1
    while reach * 2 <= shape.span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < shape.span:
        least = np.minimum(least[: len(least) - (shape.span - reach)], least[shape.span - reach :])
    place = (least & low).astype(np.int64)  # of each start
    inside = np.ones(len(place), bool)
    for end in ends[:-1]:
        inside[max(0, end - shape.width + 1) : end] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    chosen = place[starts]
    new = np.concatenate([[True], (np.diff(chosen) != 0) | (np.diff(starts) != 1)])
    first = starts[new]
    last = starts[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]
    at = chosen[new]
    return first, last, at, hashes[at]


def _parts(batches, shape):
    """Pieces of about PART_BYTES: the bytes, where each text (or part of a very long one) ends, and whose it is."""
    held, owners, size = [], [], 0

    def flush():
        data = np.frombuffer(b"".join(held), np.uint8)
        return data, np.cumsum([len(x) for x in held]), [np.array(x, np.int64) for x in zip(*owners)]

    for batch in batches:
        ids = batch.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        hashes = batch.column(1).to_numpy(zero_copy_only=False)
        for i, text in enumerate(batch.column(2)):
            text = text.as_py()
            # Parts of one text overlap by all but one byte of a string, so that each string lies in one of them.
            for at in range(0, max(1, len(text) - shape.width + 1), PART_BYTES):
                part = text[at : at + PART_BYTES + shape.width - 1]
                if len(part) < shape.width:
                    continue
                held.append(part)
                owners.append((ids[i], hashes[i], at))
                size += len(part)
                if size >= PART_BYTES:
                    yield flush()
                    held, owners, size = [], [], 0
    if held:
        yield flush()


def _marked(bits, slots):
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def _places(low, bits):
    """Two places among 2^bits for each of some 32-bit hashes."""
    return [((low * np.uint32(odd)) >> np.uint32(32 - bits)).astype(np.int64) for odd in (1, 0x9E3779B1)]


def _keys(grams):
    """Gram hashes mixed again: anchors are grams of the least hashes, whose first bits are mostly zeros."""
    return _mixed([grams])


def _low(keys, depth):
    """The 32 bits of each key that follow those of its slice, of which there are 2^depth."""
    return (keys >> np.uint64(32 - depth)).astype(np.uint32)


def _passing(bits, depth, grams):
    """Which grams the filter lets through. Its slices lie one after the other."""
    keys, size = _keys(grams), (len(bits) * 8).bit_length() - 1 - depth
    part = ((keys >> np.uint64(63 - depth)) >> np.uint64(1)).astype(np.int64) << size
    one, two = _places(_low(keys, depth), size)
    passing = _marked(bits, part + one)
    passing[passing] = _marked(bits, (part + two)[passing])
    return passing


def _listed(low):
    """Ascending 32-bit numbers as the differences between them, all first bytes, then all second ones and so on."""
    return np.diff(low, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unlisted(listed):
    planes = np.frombuffer(listed, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def _most(grams, counts):
    """Counts added up by gram, of the largest only."""
    grams, place = np.unique(grams, return_inverse=True)
    counts = np.bincount(place, weights=counts, minlength=len(grams)).astype(np.int64)
    keep = np.argsort(-counts, kind="stable")[:MOST_CROWDED]
    return grams[keep], counts[keep]


def _texts(data, first, last, grams, shape):
    """A hash for the text of each anchor, by both its ends."""
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    return _mixed([grams, words[first], words[last + shape.width - 8]])


def _gram_hashes(shape, salts, depth):
    """Per run of text its gram hashes, those that come again twice, as sorted lists in 2^depth slices; and per task the
    grams with the most texts."""

    def run(batches):
        crowds, held, size, total = (np.empty(0, np.uint64), np.empty(0, np.int64)), [], 0, 0
        salt = TaskContext.get().partitionId() % salts

        def crowded(texts, grams):
            # A gram has at most as many texts as it has places.
            sorted_grams = np.sort(grams)
            new = np.flatnonzero(np.concatenate([[True], sorted_grams[1:] != sorted_grams[:-1]]))
            many = np.diff(new, append=len(grams)) >= CROWD_LOCAL
            often = _among(grams, sorted_grams[new[many]])
            _, one = np.unique(texts[often], return_index=True)
            values, counts = np.unique(grams[often][one], return_counts=True)
            most = counts >= CROWD_LOCAL
            return _most(np.concatenate([crowds[0], values[most]]), np.concatenate([crowds[1], counts[most]]))

        def lists(grams):
            keys = np.sort(_keys(grams))
            third = np.concatenate([[False, False], keys[2:] == keys[:-2]])[: len(keys)]
            keys = keys[~third]
            low = _low(keys, depth)
            ends = [*np.searchsorted(keys, np.arange(1, 1 << depth, dtype=np.uint64) << np.uint64(64 - depth)), len(keys)]
            begin = 0
            for number, end in enumerate(map(int, ends)):
                if end > begin:
                    yield _gram_batch(number, 0, _packed(_listed(low[begin:end])))
                begin = end

        for data, ends, _ in _parts(batches, shape):
            first, last, _, grams = anchors(data, ends, shape)
            if not len(grams):
                continue
            held.append((_texts(data, first, last, grams, shape), grams))
            total += len(grams)
            size += len(data)
            if size >= RUN_BYTES:
                texts, grams = (np.concatenate(x) for x in zip(*held))
                held, size, crowds = [], 0, crowded(texts, grams)
                yield from lists(grams)
        if held:
            texts, grams = (np.concatenate(x) for x in zip(*held))
            crowds = crowded(texts, grams)
            yield from lists(grams)
        if total:
            yield _gram_batch(CROWDS, salt, _packed(*crowds, np.array([total])))

    return run


def _gram_batch(number, salt, blob):
    columns = [pa.array([number], pa.int32()), pa.array([salt], pa.int32()), pa.array([blob], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["slice", "salt", "blob"])


def _either(group):
    grams, counts, totals = (np.concatenate(x) for x in zip(*map(_unpacked, group["blob"])))
    return _packed(*_most(grams, counts), np.array([totals.sum()]))


def _repeated(size):
    """A slice of the filter, 2^size bits, that marks the gram hashes which are listed twice or more."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[:1].copy()
        if first["slice"].iloc[0] == CROWDS:
            first["blob"] = [_either(group)]
            return first
        low = np.sort(np.concatenate([_unlisted(*_unpacked(blob)) for blob in group["blob"]]))
        low = low[1:][low[1:] == low[:-1]]
        marks = np.zeros(1 << size, bool)
        for places in _places(low, size):
            marks[places] = True
        first["blob"] = [_packed(np.packbits(marks, bitorder="little"))]
        return first

    return run


def _last_crowds(group: pd.DataFrame) -> pd.DataFrame:
    first = group.iloc[:1].copy()
    if first["slice"].iloc[0] == CROWDS:
        first["blob"] = [_either(group)]
    return first


def _among(values, ascending):
    """Which values are among others that ascend."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def _suffix_rows(data, first, last, at, shape):
    """Per anchor a row of bytes: the suffix from its gram to the end of its last string, then what precedes the gram
    back to the start of its first string, zeros, and both lengths. Equal rows are equal texts around equal grams."""
    right, left = last + shape.width - at, at - first
    before = shape.span - 1
    padded = np.concatenate([np.zeros(before, np.uint8), data, np.zeros(shape.width, np.uint8)])
    rows = np.zeros((len(at), shape.row), np.uint8)
    rows[:, : shape.width] = np.lib.stride_tricks.sliding_window_view(padded, shape.width)[at + before]
    rows[:, : shape.width] *= np.arange(shape.width) < right[:, None]
    back = np.lib.stride_tricks.sliding_window_view(padded, before)[at][:, ::-1] * (np.arange(before) < left[:, None])
    for length in np.unique(right):
        own = np.flatnonzero(right == length)
        rows[own, length : length + before] = back[own]
    rows[:, -2], rows[:, -1] = right, left
    return rows


def common_prefixes(rows):
    """How many bytes each row shares with the one before it; 0 for the first."""
    differs = rows[1:] != rows[:-1]
    length = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return np.concatenate([[0], length])


def front_coded(rows):
    """A sorted run as common prefix lengths, and the bytes beyond them."""
    prefixes = common_prefixes(rows)
    return prefixes.astype(np.uint8), rows[np.arange(rows.shape[1]) >= prefixes[:, None]]


def decoded(prefixes, rest, width):
    """The rows of a front-coded run, or of several one after the other, as the first row of each is whole."""
    rows = np.empty((len(prefixes), width), np.uint8)
    rows[np.arange(width) >= prefixes[:, None]] = rest
    partly = np.flatnonzero(prefixes)
    for column in range(width):
        partly = partly[prefixes[partly] > column]
        if not len(partly):
            break
        # Neighbours that all lack this byte have it from the row before them.
        new = np.diff(partly, prepend=-1) != 1
        rows[partly, column] = rows[partly[new] - 1, column][np.cumsum(new) - 1]
    return rows


def _single_strings(data, first, last, shape):
    """The starts of all strings of some anchors, and a hash of each string."""
    counts = last - first + 1
    starts = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    places = [*range(0, shape.width - 8, 8), shape.width - 8]
    return starts, _mixed([words[starts + place] for place in places])


def _suffixes(batches, shape, bits, depth, crowded):
    """Runs of about RUN_BYTES of text: the suffixes that may repeat, as rows, with their piece, start and the hash they
    are dealt by (of the gram, or of the string around a crowded gram), and whose the pieces are."""
    found, owners, pieces, size = [], [], 0, 0

    def flush():
        parts = [np.concatenate(x) for x in zip(*found)]
        return *parts, *[np.concatenate(x) for x in zip(*owners)]

    for data, ends, whose in _parts(batches, shape):
        first, last, at, grams = anchors(data, ends, shape)
        often = _passing(bits, depth, grams)
        first, last, at, grams = first[often], last[often], at[often], grams[often]
        crowd = _among(grams, crowded)
        if crowd.any():
            starts, hashes = _single_strings(data, first[crowd], last[crowd], shape)
            first, last, at = (np.concatenate([x[~crowd], starts]) for x in (first, last, at))
            grams = np.concatenate([grams[~crowd], hashes])
        piece = np.searchsorted(ends, first, side="right")
        begin = np.concatenate([[0], ends])[piece]
        found.append((_suffix_rows(data, first, last, at, shape), piece + pieces, first - begin, grams))
        owners.append(whose)
        pieces += len(ends)
        size += len(data)
        if size >= RUN_BYTES:
            yield flush()
            found, owners, pieces, size = [], [], 0, 0
    if found:
        yield flush()


def _local_runs(shape, filter_map, depth, crowded, buckets):
    """Per run of text: sorted front-coded suffixes per bucket, the pieces of text they are from, and what of it an
    earlier document in the same run covers already."""

    def run(batches):
        (bits,) = _unpacked(filter_map.value)
        number = TaskContext.get().partitionId() * TASK_RUNS
        for rows, piece, start, grams, ids, hashes, offsets in _suffixes(batches, shape, bits, depth, crowded.value):
            number += 1
            if not len(rows):
                continue
            order = np.argsort(rows.view(f"S{shape.row}").ravel(), kind="stable")
            rows, piece, start, grams = rows[order], piece[order], start[order], grams[order]
            heads = np.flatnonzero(common_prefixes(rows) < shape.row)
            least = np.minimum.reduceat(ids[piece], heads)
            later = ids[piece] > np.repeat(least, np.diff(heads, append=len(rows)))
            lengths = rows[:, -2].astype(np.uint32) + rows[:, -1]
            covered = piece[later].astype(np.uint32), start[later].astype(np.uint32), lengths[later]
            out = [
                (number % buckets, number, PIECES, _packed(ids, hashes, offsets)),
                (number % buckets, number, COVERED, _packed(*covered)),
            ]
            rows, piece, start, grams = rows[~later], piece[~later], start[~later], grams[~later]
            # One sorted run, dealt out by bucket; rows of a bucket stay in order.
            bucket = (grams % np.uint64(buckets)).astype(np.int64)
            dealt = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[dealt], np.arange(buckets + 1))
            for b in range(buckets):
                own = dealt[cuts[b] : cuts[b + 1]]
                if not len(own):
                    continue
                used, place = np.unique(piece[own], return_inverse=True)
                coded = front_coded(rows[own])
                kind = np.uint16 if len(used) < 1 << 16 else np.uint32
                whose = used.astype(np.uint32), ids[used], place.astype(kind), start[own].astype(np.uint32)
                blob = _packed(*coded, *whose, level=3)
                out.append((b, number, SUFFIXES, blob))
                if len(out) >= 16:
                    yield _local_batch(out)
                    out = []
            if out:
                yield _local_batch(out)

    return run


def _local_batch(rows):
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "run", "kind", "blob"])


def merge(runs, width):
    """Merge sorted runs of equally long byte strings: the run of each output and its common prefix with the one before.

    `runs` are (rows, prefixes), rows as bytes or as a table of bytes.
    """
    runs = [np.frombuffer(b"".join(map(bytes, rows)), np.uint8).reshape(-1, width) for rows, _ in runs]
    order, _, prefixes = merged(np.concatenate(runs), width)
    return np.repeat(np.arange(len(runs)), [len(rows) for rows in runs])[order].tolist(), prefixes.tolist()


def merged(rows, width):
    """Merge sorted runs of rows that lie one after the other: the order, the rows in it, and what each shares with the
    one before it. The stable sort of numpy takes ascending runs as they lie and merges neighbouring ones."""
    if not len(rows):
        return np.empty(0, np.int64), rows, np.empty(0, np.int64)
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
    rows = rows[order]
    return order, rows, common_prefixes(rows)


def _without_singles(rows, shape):
    """The places of the rows whose gram another row has."""
    grams = _mixed(list(np.ascontiguousarray(rows[:, : shape.gram]).view("<u8").T))
    values = np.sort(grams)
    return np.flatnonzero(_among(grams, values[1:][values[1:] == values[:-1]]))


def _covers(shape):
    """Merge the runs of one bucket, and say per run which of its text an earlier document covers."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = [(r, k, b) for r, k, b in zip(group["run"], group["kind"], group["blob"]) if k != SUFFIXES]
        suffixes = group.loc[group["kind"] == SUFFIXES, ["run", "blob"]].sort_values("run")
        if not len(suffixes):
            return pd.DataFrame(out, columns=["run", "kind", "blob"])
        parts = []
        for blob in suffixes["blob"]:
            prefixes, rest, used, ids, place, start = _unpacked(blob)
            parts.append((prefixes, rest, ids[place], used[place], start))
        numbers = np.repeat(suffixes["run"].to_numpy(np.int64), [len(part[0]) for part in parts])
        prefixes, rest, ids, piece, start = (np.concatenate(x) for x in zip(*parts))
        rows = decoded(prefixes, rest, shape.row)
        kept = _without_singles(rows, shape)
        if len(kept):
            order, rows, prefixes = merged(rows[kept], shape.row)
            kept = kept[order]
            ids, piece, start, numbers = ids[kept], piece[kept], start[kept], numbers[kept]
            which, begin, length = _covered(rows, prefixes, ids, start, shape)
            dealt = np.argsort(numbers[which], kind="stable")
            which, begin, length = which[dealt], begin[dealt].astype(np.uint32), length[dealt].astype(np.uint32)
            ends = [*np.flatnonzero(np.diff(numbers[which])) + 1, len(which)]
            for a, b in zip([0, *ends], ends):
                if b > a:
                    blob = _packed(piece[which[a:b]].astype(np.uint32), begin[a:b], length[a:b])
                    out.append((int(numbers[which[a]]), COVERED, blob))
        return pd.DataFrame(out, columns=["run", "kind", "blob"])

    return run


def _covered(rows, prefixes, ids, start, shape):
    """Which of the merged rows are covered by an earlier document, from where and how far."""
    start = start.astype(np.int64)
    text = np.cumsum(prefixes < shape.row) - 1  # equal rows
    heads = np.flatnonzero(prefixes < shape.row)
    least = np.minimum.reduceat(ids, heads)
    lengths = rows[:, -2].astype(np.int64) + rows[:, -1]
    full = ids > least[text]
    which, begin, length = [np.flatnonzero(full)], [start[full]], [lengths[full]]
    # Different texts around one gram may still have strings in common.
    grams = np.flatnonzero(prefixes[heads] < shape.gram)
    sizes = np.diff(grams, append=len(heads))
    mixed = np.repeat(np.minimum.reduceat(least, grams) != np.maximum.reduceat(least, grams), sizes)
    if mixed.any():
        texts = np.flatnonzero(mixed)
        owner, hit, reach = _shared_strings(rows[heads[texts]], least[texts], shape)
        firsts = np.flatnonzero(~full & mixed[text])
        own, count = np.unique(text[firsts], return_index=True, return_counts=True)[1:]
        # Each span belongs to all the rows of its text that are from its least document.
        times = count[owner]
        row = firsts[np.repeat(own[owner] - np.cumsum(times) + times, times) + np.arange(times.sum())]
        which.append(row)
        begin.append(start[row] + np.repeat(hit, times))
        length.append(np.repeat(reach, times))
    return np.concatenate(which), np.concatenate(begin), np.concatenate(length)


def _shared_strings(rows, least, shape):
    """Spans of different texts that lie in strings which texts of a smaller id hold too: whose, from where, how far.

    Equal strings have equal grams at equal offsets, so strings are taken by that offset. They are sorted by a hash, and
    by themselves should any two different ones share it.
    """
    before = shape.span - 1
    right, left = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    # All texts with their grams at the same place, and zeros around.
    aligned = np.zeros((len(rows), shape.text), np.uint8)
    aligned[:, before:] = rows[:, : shape.width] * (np.arange(shape.width) < right[:, None])
    for length in np.unique(right):
        own = np.flatnonzero(right == length)
        aligned[own, :before] = rows[own, length : length + before][:, ::-1]
    words = np.ndarray((len(rows), shape.text - 7), "<u8", aligned, 0, (shape.text, 1))
    places = [*range(0, shape.width - 8, 8), shape.width - 8]
    owners, offsets, hashes = [], [], []
    for offset in range(shape.span):
        own = np.flatnonzero((left >= offset) & (right >= shape.width - offset))
        owners.append(own)
        offsets.append(np.full(len(own), offset))
        hashes.append(_mixed([words[own, before - offset + place] for place in places]))
    owner, offset, hashes = (np.concatenate(x) for x in (owners, offsets, hashes))
    strings = np.lib.stride_tricks.sliding_window_view(aligned, shape.width, axis=1)
    order = np.argsort(hashes, kind="stable")
    equal = hashes[order][1:] == hashes[order][:-1]
    pairs = np.flatnonzero(equal)
    for at in range(0, len(pairs), 1 << 16):
        one, two = (order[pairs[at : at + (1 << 16)] + i] for i in (0, 1))
        if (strings[owner[one], before - offset[one]] != strings[owner[two], before - offset[two]]).any():
            each = strings[owner, before - offset]
            order = np.argsort(each.view(f"S{shape.width}").ravel(), kind="stable")
            equal = (each[order][1:] == each[order][:-1]).all(axis=1)
            break
    owner, place = owner[order], (left[owner] - offset)[order]
    new = np.concatenate([[True], ~equal])
    earliest = np.minimum.reduceat(least[owner], np.flatnonzero(new))
    hits = least[owner] > earliest[np.cumsum(new) - 1]
    # Neighbouring strings of one text are one span.
    key = np.sort(owner[hits] * shape.row + place[hits])
    ends = np.flatnonzero(np.diff(key, append=-1) != 1)
    firsts = key[np.concatenate([[0], ends[:-1] + 1])] if len(key) else key
    return firsts // shape.row, firsts % shape.row, key[ends] - firsts + shape.width


def _joined(starts, ends):
    """Maximal runs of what the spans cover; `starts` ascend."""
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]


def _spans(group: pd.DataFrame) -> pd.DataFrame:
    """Per piece of one run's text the spans that are covered."""
    ids, hashes, offsets = next(_unpacked(b) for k, b in zip(group["kind"], group["blob"]) if k == PIECES)
    parts = [_unpacked(b) for k, b in zip(group["kind"], group["blob"]) if k == COVERED]
    piece, start, length = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
    out = []
    if len(piece):
        key = (piece << 32) + start
        order = np.argsort(key, kind="stable")
        first, last = _joined(key[order], (key + length)[order])
        owner = first >> 32
        spans = np.stack([first, last], axis=1) - (owner << 32)[:, None] + offsets[owner][:, None]
        ends = [*np.flatnonzero(np.diff(owner)) + 1, len(owner)]
        for a, b in zip([0, *ends], ends):
            p = owner[a]
            out.append((ids[p] if ids[p] != NO_ID else None, hashes[p], spans[a:b].astype("<i8").tobytes()))
    found = pd.DataFrame(out, columns=["id", "h", "spans"])
    found["id"] = found["id"].astype("Int64")
    return found


@F.pandas_udf(CUT)
def _cut(texts: pd.Series, covered: pd.Series) -> pd.DataFrame:
    rows = []
    for text, blobs in zip(texts, covered):
        if blobs is None or not len(blobs):
            rows.append((text, len(text), 0, 0, []))
            continue
        spans = np.concatenate([np.frombuffer(blob, "<i8").reshape(-1, 2) for blob in blobs])
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        first, last = _joined(spans[:, 0], spans[:, 1])
        keep = np.ones(len(text), bool)
        for a, b in zip(first, last):
            keep[a:b] = False
        kept = np.frombuffer(text, np.uint8)[keep].tobytes()
        flat = np.stack([first, last], axis=1).ravel().tolist()
        rows.append((kept, len(text), len(text) - len(kept), len(first), flat))
    return pd.DataFrame(rows, columns=["kept", "n_bytes", "n_removed", "n_spans", "spans"])


def repeated_grams(inputs, shape, salts=4, depth=SLICES.bit_length() - 1, size=None):
    """The bits of a filter that lets all grams through which come twice, compressed, and the hashes of crowded grams.

    The tasks list the hashes of their grams in 2^depth slices, and each slice is looked through for those that come
    twice, so that no task holds more than a slice. Only these are marked, in 2^size bits. The tasks' crowded grams are
    merged in `salts` groups first, and then those of the groups.
    """
    size = FILTER_BITS if size is None else size
    schema = "slice int, salt int, blob binary"
    listed = inputs.mapInArrow(_gram_hashes(shape, salts, depth), schema)
    found = listed.groupBy("slice", "salt").applyInPandas(_repeated(size - depth), schema)
    parts = found.groupBy("slice").applyInPandas(_last_crowds, schema).collect()
    step = (1 << size) // 8 >> depth
    bits, crowded = np.zeros(step << depth, np.uint8), np.empty(0, np.uint64)
    for part in parts:
        if part["slice"] == CROWDS:
            grams, counts, (total,) = _unpacked(part["blob"])
            crowded = np.sort(grams[counts >= max(CROWD, total // CROWD_SHARE)])
        else:
            bits[part["slice"] * step : (part["slice"] + 1) * step] = _unpacked(part["blob"])[0]
    return _packed(bits), crowded


def filter_shape(total):
    """The logarithms of the filter's slices and bits for so many bytes of text."""
    depth = max(SLICES, -(-total // SLICE_BYTES)).bit_length() - 1
    return depth, max(depth + 3, min(FILTER_BITS, (total // FILTER_BYTES).bit_length() - 1))


def remove_repeats(docs, width=50, id_col=DOC_ID, text_col=TEXT):
    """The columns of `docs`, then `kept` (binary, what is left of the text's UTF-8), `n_bytes`, `n_removed`, `n_spans`
    and `spans` (starts and ends of the maximal removed runs, in bytes).

    A byte goes if it lies in a string of `width` bytes that also starts in a document of a smaller id. Strings are
    grouped by their least gram, so that one suffix stands for about a dozen neighbouring strings. Tasks sort the
    suffixes of about RUN_BYTES of text and exchange them as front-coded runs, dealt by a hash of the gram; a bucket's
    runs are merged. Equal rows are equal texts, of which only the least document keeps its own; the strings of
    different texts around one gram are sorted too, and met. Each run's text is told what is
    covered, spans are joined per document, and each row cuts its own text.

    Three things keep the exchange small and even. A suffix that an earlier document repeats within the run is settled there, so
    a passage that a third of all documents share sends one suffix per run. And a first pass exchanges the hashes of all
    grams, in slices that grow in number with the text, and marks those that come twice in a filter that is broadcast
    (64 MB at most); suffixes of other grams cannot repeat and stay home. Grams that come once take no room in it.
    A filter that fills up lets more through, but never changes the result. And grams around which very many different
    texts lie, such as the first of a passage that all kinds of documents quote, are counted in that pass too: their
    strings are dealt out one by one, so no task gets all the texts around one gram. Crowded grams (at most
    MOST_CROWDED, broadcast) only decide what goes where; any two equal strings meet either way.

    Defined cases: null and empty texts have no bytes. A null id counts as larger than any other. Rows that share an
    id are one document: nothing in one is removed for another. Texts shorter than `width` stay. A very long text is
    worked on in overlapping parts. Columns of `docs` called like a result are replaced; an empty table gives an empty
    result. The rows of `docs` are read in three passes, which must find the same rows in the same partitions, as
    scans of files do; stage anything else first.
    """
    shape = Shape(width)
    key = row_key(id_col, text_col)
    inputs = in_small_batches(docs).select(
        F.col(id_col).cast("bigint").alias("id"),
        key.getField("h").alias("h"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    total = inputs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(1, -(-total // BUCKET_BYTES)))
    salts = max(4, math.isqrt(total // RUN_BYTES))
    depth, size = filter_shape(total)
    found = repeated_grams(inputs, shape, salts, depth, size)
    bits, crowded = map(docs.sparkSession.sparkContext.broadcast, found)
    runs = inputs.mapInArrow(_local_runs(shape, bits, depth, crowded, buckets), LOCAL)
    covers = runs.groupBy("bucket").applyInPandas(_covers(shape), "run bigint, kind int, blob binary")
    spans = covers.groupBy("run").applyInPandas(_spans, "id bigint, h bigint, spans binary")
    spans = spans.groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(F.collect_list("spans").alias("_spans"))
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.col(id_col).cast("bigint").alias("id"),
        key.getField("h").alias("h"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    met = rows.join(spans, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    results = ["kept", "n_bytes", "n_removed", "n_spans", "spans"]
    columns = [F.col("row").getField(name).alias(name) for name in docs.columns if name not in results]
    return met.select(*columns, _cut("text", "_spans").alias("_cut")).select(
        *[f"`{name}`" for name in docs.columns if name not in results], "_cut.*"
    )
