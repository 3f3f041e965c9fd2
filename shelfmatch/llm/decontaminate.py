"""Benchmark passages in documents, with edits: q-gram lemma filter and banded alignment.

An item of m characters that occurs in a text with at most e edits shares at least m - q + 1 - q * e of its q-grams with
it, all on diagonals (place in the text less place in the item) that lie within e of each other. Shared q-grams are
counted in bands of diagonals that overlap by e, so each such occurrence falls whole into one band; bands that reach the
bound are kept, and an alignment limited to the band's diagonals verifies them.

Occurrences of a q-gram that follow one another closely in a text are one interval of bands, so a run of one character or of a
few costs what its length does, not its length times that of an item's run. Bands in a row are aligned in one table.

The same holds for windows of ``REGION`` characters of longer items, one every ``STEP`` and one at the end: a text that holds
only a part of an item is found by its windows, which are joined to regions.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import by_text, doc_texts, unused

#: Characters of a q-gram, and edits for each character of an item.
GRAM, EDIT_RATE = 10, 0.08
#: Characters of the windows that parts of longer items are found by, and places from one to the next. Any part that is
#: as long as both together, and any ``REGION`` characters at an end of an item, hold a window.
REGION, STEP = 100, 25
#: Characters of benchmark items that one pass over the documents looks for.
BLOCK_CHARS = 4 << 20
#: Characters of a document that are matched at once.
CHUNK = 1 << 20
#: Bands in a row that are aligned one by one, and diagonals of a table for more.
FEW_BANDS, PIECE = 3, 1 << 15
FIELDS = ("item_id", "start", "stop", "edits", "item_start", "item_stop", "item_chars")

_MULT = np.random.Generator(np.random.PCG64(12)).integers(1 << 30, 1 << 31, 40, dtype=np.uint32) * 2 + 1
_SPACE = np.zeros(0x110000, bool)
_SPACE[[*range(9, 14), 32, 0xA0]] = True


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with one space for a run of white space, none at the ends; and where each stood.

    Characters whose lower case is longer than one stay as they are, so places can be given.
    """
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    points = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _SPACE[points]
    points = np.where(space, np.uint32(32), points)
    keep = ~space
    keep[1:] |= ~space[:-1]
    if keep.all():
        places, out = np.arange(len(points)), points
    else:
        places, out = np.flatnonzero(keep), points[keep]
    if len(out) and out[-1] == 32:
        out, places = out[:-1], places[:-1]
    if len(out) and out[0] == 32:
        out, places = out[1:], places[1:]
    return out, places


def gram_codes(points: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of every q-gram, from those of half the length; the alignment tells unequal q-grams apart."""
    n, done, out, at = len(points) - q + 1, 1, None, 0
    if n < 1:
        return np.empty(0, np.uint32)
    have = points * _MULT[0]
    have ^= have >> 15
    while True:
        if q & done:
            part = have[at:at + n]
            out = part if out is None else out * _MULT[1] + part
            at += done
        if done * 2 > q:
            break
        have, done = have[:-done] * _MULT[2 + done.bit_length()] + have[done:], done * 2
    out = (out ^ (out >> 16)) * _MULT[2]
    return out ^ (out >> 15)


def edit_budget(m: int, q: int, rate: float) -> int:
    """Edits allowed in an item: ``rate`` of its characters, but so few that the bound on shared q-grams is positive."""
    return max(0, min(int(m * rate), (m - q) // q))


def equal_run(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two arrays have in common from their beginnings."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        other = a[at:min(at + step, n)] != b[at:min(at + step, n)]
        if other.any():
            return at + int(other.argmax())
        at, step = at + step, step * 4
    return n


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """The best occurrence of ``item`` in ``text`` on diagonals ``low`` to ``high``: start, stop, edits; ``None`` over ``edits``.

    Among equals the occurrence that ends first wins, and of those the one that starts last.
    """
    m = len(item)
    for at in range(max(0, low), min(high, len(text) - m) + 1):  # a diagonal without an edit is the best there can be
        if text[at] == item[0] and np.array_equal(text[at:at + m], item):
            return at, at + m, 0
    ends = align_all(item, text, low, high, edits)
    if ends is None:
        return None
    cost, origin = ends
    end = int(cost.argmin())
    return int(origin[end]), low + end + m, int(cost[end])


def align_all(item: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Edits (at most ``edits`` + 1) and start of the best occurrence that ends on each of the diagonals ``low`` to ``high``.

    Each row of the table is one array over the diagonals. ``None`` if all have more than ``edits``.
    """
    width, m, far = high - low + 1, len(item), np.int32(edits + 1)
    cell = np.arange(width, dtype=np.int32)
    start = cell + np.int32(low)  # text place of row 0 on each diagonal
    own = text[max(low, 0):max(0, high + m)]
    line = np.full(width + m - 1, 0xFFFFFFFF, np.uint32)  # line[i + k] is the text's place low + i + k
    line[max(0, -low):max(0, -low) + len(own)] = own
    edge = low < 0 or high + m > len(text)
    cost = np.where((start >= 0) & (start <= len(text)), np.int32(0), far)
    origin = start.copy()
    for i in range(m):
        step = cost + (line[i:i + width] != item[i])
        drop = np.append(cost[1:], far) + np.int32(1)  # item character left out: same text place, next diagonal down
        take = drop < step
        new, begin = np.where(take, drop, step), np.where(take, np.append(origin[1:], np.int32(0)), origin)
        # Text characters put in, running along the row: least of new[k] + (j - k).
        slope = new - cell
        best = np.minimum.accumulate(slope)
        fresh = np.concatenate(([True], slope[1:] < best[:-1]))
        source = np.maximum.accumulate(np.where(fresh, cell, np.int32(0)))
        cost = np.minimum(best + cell, far)
        if edge:
            stop = start + np.int32(i + 1)
            cost[(stop < 0) | (stop > len(text))] = far
        origin = begin[source]
        if cost.min() > edits:
            return None
    return cost, origin


def align_stretch(item: np.ndarray, text: np.ndarray, low: int, bands: int, edits: int) -> Iterator[tuple[int, int, int]]:
    """The best occurrences (as by ``align``) in so many bands in a row, the first of them from diagonal ``low``.

    Few bands give one each. Of more, which repetitive texts have, all diagonals go through one table, piece by piece, and of
    occurrences that overlap in the text the best, then first one counts.
    """
    if bands <= FEW_BANDS:
        for at in range(bands):
            hit = align(item, text, low + at * (edits + 1), low + at * (edits + 1) + 2 * edits, edits)
            if hit:
                yield hit
        return
    most = max(1, PIECE // (edits + 1))
    for first in range(0, bands, most):
        n, base = min(most, bands - first), low + first * (edits + 1)
        ends = align_all(item, text, base, base + (n - 1) * (edits + 1) + 2 * edits, edits)
        if ends is None:
            continue
        end = np.flatnonzero(ends[0] <= edits)
        cost, begin = ends[0][end], ends[1][end]
        begins, taken = [], []
        for i in np.lexsort((end, begin, cost)).tolist():
            a, b = int(begin[i]), base + int(end[i]) + len(item)
            k = bisect_left(begins, a)
            if (k == 0 or taken[k - 1][1] <= a) and (k == len(begins) or b <= begins[k]):
                begins.insert(k, a)
                taken.insert(k, (a, b, int(cost[i])))
        yield from taken


class Index:
    """The q-grams of a block of items, sorted, with the item and place of each."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float):
        self.q, self.rate, self.ids, self.texts, self.budgets = q, rate, [], [], []
        self.short: list[tuple[int, str]] = []
        codes, owners, places = [], [], []
        for number, text in items:
            points, _ = folded(text or "")
            if len(points) < q:
                if len(points):
                    self.short.append((number, points))
                continue
            own = gram_codes(points, q)
            codes.append(own)
            owners.append(np.full(len(own), len(self.ids)))
            places.append(np.arange(len(own)))
            self.ids.append(number)
            self.texts.append(points)
            self.budgets.append(edit_budget(len(points), q, rate))
        self.codes = np.concatenate([np.empty(0, np.uint32), *codes])
        order = np.argsort(self.codes, kind="stable")
        self.codes = self.codes[order]
        self.owners = np.concatenate([np.empty(0, np.int64), *owners]).astype(np.int64)[order]
        self.places = np.concatenate([np.empty(0, np.int64), *places]).astype(np.int64)[order]
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        # Units are searched for: the items, and after them the windows of those over REGION characters.
        more = np.where(self.lengths > REGION, (self.lengths - REGION) // STEP + 1, 0)  # at multiples of STEP
        odd = (more > 0) & ((self.lengths - REGION) % STEP > 0)  # one more at the end
        n = len(self.texts)
        self.regular, self.odd, self.first_window = more, odd, n + np.cumsum(more + odd) - more - odd
        whose = np.repeat(np.arange(n), more + odd)
        number = np.arange(len(whose)) + n - self.first_window[whose]
        self.unit_item = np.concatenate((np.arange(n), whose))
        self.unit_start = np.concatenate((np.zeros(n, np.int64), np.minimum(number * STEP, self.lengths[whose] - REGION)))
        self.unit_length = np.concatenate((self.lengths, np.full(len(whose), REGION)))
        self.edits = np.array([*self.budgets, *[edit_budget(REGION, q, rate)] * len(whose)], np.int64)
        # A bit table says at once for most q-grams of a text that no item has them.
        self.bits = min(28, max(16, int(len(self.codes)).bit_length() + 5))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.codes >> (32 - self.bits)] = True
        self.reach = int((self.unit_length + 2 * self.edits).max(initial=0))

        # Occurrences of a q-gram in a text count as one stretch where no band lies between them: up to 2e + 1 places apart,
        # which differs by unit; these are the gaps that units of few edits, of more, and the windows allow.
        self.gaps = sorted({1, 3, 7, 2 * edit_budget(REGION, q, rate) + 1})
        gap = np.array(self.gaps)
        self.gap_class = np.maximum(np.searchsorted(gap, 2 * self.edits + 1, side="right") - 1, 0)
        self.bounds = self.unit_length - q + 1 - q * self.edits
        self.least = np.where(more > 0, np.minimum(self.bounds[:n], REGION - q + 1 - q * edit_budget(REGION, q, rate)), self.bounds[:n])
        self.classes = {*self.gap_class[:n].tolist(), len(gap) - 1}

    def stretches(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and places of the text's q-grams that items have, by code, then place."""
        code = gram_codes(points, self.q)
        at = np.flatnonzero(self.seen[code >> (32 - self.bits)])
        code = code[at]
        first = np.searchsorted(self.codes, code)
        first[first == len(self.codes)] = 0
        own = np.flatnonzero(self.codes[first] == code) if len(self.codes) else np.empty(0, np.int64)
        code, at = code[own], at[own]
        order = np.argsort(code, kind="stable")
        return code[order], at[order]

    def unit_hits(self, code: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Unit, place in the unit, first and last place in the text of every stretch of a shared q-gram: those of an item and
        of its windows."""
        for number, gap in enumerate(self.gaps):
            if number not in self.classes:
                continue
            new = np.concatenate(([True], (code[1:] != code[:-1]) | (at[1:] - at[:-1] > gap)))[:len(code)]
            begins = np.flatnonzero(new)
            starts, stops, own = at[begins], at[np.append(begins[1:], len(at)) - 1] if len(at) else at, code[begins]
            first, last = np.searchsorted(self.codes, own), np.searchsorted(self.codes, own, side="right")
            count = last - first
            which = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            owner, place = self.owners[which], self.places[which]
            many = np.bincount(owner, minlength=len(self.least))[owner] >= self.least[owner]  # else no unit can reach its bound
            if not many.any():
                continue
            owner, place, starts, stops = owner[many], place[many], np.repeat(starts, count)[many], np.repeat(stops, count)[many]
            mine = np.flatnonzero(self.gap_class[owner] == number)
            yield owner[mine], place[mine], starts[mine], stops[mine]
            if number != len(self.gaps) - 1:
                continue
            for back in range(REGION // STEP):
                window = place // STEP - back
                mine = np.flatnonzero((window >= 0) & (window < self.regular[owner]) & (place + self.q <= window * STEP + REGION))
                yield self.first_window[owner[mine]] + window[mine], place[mine] - window[mine] * STEP, starts[mine], stops[mine]
            mine = np.flatnonzero(self.odd[owner] & (place >= self.lengths[owner] - REGION))
            yield self.first_window[owner[mine]] + self.regular[owner[mine]], place[mine] - self.lengths[owner[mine]] + REGION, starts[mine], stops[mine]

    def bands(self, points: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Units, first diagonals and numbers of bands in a row that all have enough shared q-grams.

        A unit with e edits has bands of 2e + 1 diagonals every e + 1, so any e + 1 diagonals in a row lie in one. A place of
        a unit counts once a band, however often its q-gram stands there. A stretch of occurrences is an interval of bands, and
        counts are sums over the ends of intervals: a run of one character costs no more than one occurrence.
        """
        code, at = self.stretches(points)
        if not len(code):
            return
        hits = list(self.unit_hits(code, at))
        if not hits:
            return
        owner, place, starts, stops = (np.concatenate(c) for c in zip(*hits, strict=True))
        if not len(owner):
            return
        order = np.lexsort((starts, place, owner))
        owner, place, starts, stops = owner[order], place[order], starts[order], stops[order]
        edits, length = self.edits[owner], self.unit_length[owner]
        low = np.maximum(0, -((2 * edits - starts + place - length) // (edits + 1)))
        high = (stops - place + length) // (edits + 1)
        again = np.flatnonzero((owner[1:] == owner[:-1]) & (place[1:] == place[:-1])) + 1
        low[again] = np.maximum(low[again], high[again - 1] + 1)
        own = np.flatnonzero(low <= high)
        owner, low, high = owner[own], low[own], high[own]
        span = int(high.max()) + 2
        ends, into = np.unique(np.concatenate((owner * span + low, owner * span + high + 1)), return_inverse=True)
        shared = np.cumsum(np.bincount(into, np.concatenate((np.ones(len(own)), -np.ones(len(own))))).astype(np.int64))
        owner, band = ends // span, ends % span
        bound = self.bounds[owner]
        enough = np.flatnonzero(shared >= bound)
        enough = enough[shared[enough] > 0]
        if not len(enough):
            return
        new = np.concatenate(([True], enough[1:] != enough[:-1] + 1))
        firsts = np.flatnonzero(new)
        lasts = enough[np.append(firsts[1:], len(enough)) - 1] + 1  # bands from there on have too few again
        for i, j in zip(enough[firsts].tolist(), lasts.tolist(), strict=True):
            unit = int(owner[i])
            yield unit, int(band[i] * (self.edits[unit] + 1) - self.unit_length[unit]), int(band[j] - band[i])

    def joined(self, item: int, finds: list[tuple[int, int, int, int]], points: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Regions made of finds of an item's windows (text start and stop, edits, item start) that follow one another in both.

        A region grows at both ends by characters that are equal. Edits, start, stop, item start and stop of each; regions
        don't overlap, those that hold most of the item come first.
        """
        whole, chains, out = self.texts[item], [], []
        # Chains are looked up by the diagonal of their last find; no two that fit are further apart than a cell.
        cell = 4 * edit_budget(REGION, self.q, self.rate) + 1
        last_at: dict[int, set[int]] = {}
        for find in sorted(set(finds), key=lambda f: (f[3], f[0])):
            diagonal = find[0] - find[3]
            near = [last_at.get(diagonal // cell + c, set()) for c in (-1, 0, 1)]
            for own in near:  # finds come by their place in the item, so what lies further back is complete
                own -= {k for k in own if find[3] - chains[k][-1][3] > REGION}
            for k in sorted(k for own in near for k in own):
                a, b, e, at = chains[k][-1]
                if 0 < find[3] - at <= REGION and find[0] < b and abs(diagonal - (a - at)) <= 2 * find[2] + 2 * e:
                    last_at[(a - at) // cell].discard(k)
                    chains[k].append(find)
                    break
            else:
                k = len(chains)
                chains.append([find])
            last_at.setdefault(diagonal // cell, set()).add(k)
        exact: dict[int, int] = {}  # where the last region without edits of a diagonal ends in the item
        for chain in chains:
            a, b, first, last = min(f[0] for f in chain), max(f[1] for f in chain), chain[0][3], chain[-1][3] + REGION
            plain = b - a == last - first and not any(f[2] for f in chain)
            if plain and last <= exact.get(a - first, 0):
                continue  # chains come by their place in the item: that region has grown over this one
            n = equal_run(points[:a][::-1], whole[:first][::-1])
            a, first = a - n, first - n
            n = equal_run(points[b:], whole[last:])
            b, last = b + n, last + n
            if plain:
                exact[a - first] = last
            most = sum(f[2] for f in chain) + abs((b - a) - (last - first))
            hit = align(whole[first:last], points[a:b], -most, most, most)
            if hit and hit[2] <= (last - first) * self.rate:
                out.append((hit[2], a + hit[0], a + hit[1], first, last))
            else:
                out += [(e, x, y, at, at + REGION) for x, y, e, at in chain]
        taken: list[tuple[int, int, int, int, int]] = []
        for region in sorted(out, key=lambda r: (r[3] - r[4], r)):
            if all(region[2] <= t[1] or region[1] >= t[2] for t in taken):
                taken.append(region)
        return taken

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """Item, start, stop (places in the text as it is) and edits; of overlapping finds of an item the best, then first."""
        return [f[:4] for f in self.regions(text)]

    def regions(self, text: str) -> list[tuple[int, int, int, int, int, int, int]]:
        """As ``search``, with the part of the folded item that was found (start and stop) and the item's characters.

        Where an item is not whole, its parts of ``REGION`` characters or more are found, with edits at the same rate.
        """
        points, origin = folded(text)
        found: dict[int, list[tuple[int, int, int]]] = {}
        parts: dict[int, list[tuple[int, int, int, int]]] = {}
        for at in range(0, max(1, len(points)), CHUNK):
            part = points[at:at + CHUNK + self.reach]
            for unit, low, n in self.bands(part):
                edits, item, first = int(self.edits[unit]), int(self.unit_item[unit]), int(self.unit_start[unit])
                for a, b, e in align_stretch(self.texts[item][first:first + int(self.unit_length[unit])], part, low, n, edits):
                    if unit < len(self.texts):
                        found.setdefault(item, []).append((e, at + a, at + b))
                    else:
                        parts.setdefault(item, []).append((at + a, at + b, e, first))
        out = []
        for owner in found.keys() | parts.keys():
            taken: list[tuple[int, int, int]] = []
            for e, a, b in sorted(set(found.get(owner, ()))):
                if all(b <= x or a >= y for _, x, y in taken):
                    taken.append((e, a, b))
            m = len(self.texts[owner])
            spans = [(e, a, b, 0, m) for e, a, b in taken]
            left = [f for f in parts.get(owner, ()) if all(f[1] <= x or f[0] >= y for _, x, y in taken)]
            if left:
                spans += [r for r in self.joined(owner, left, points) if all(r[2] <= x or r[1] >= y for _, x, y in taken)]
            out += [(self.ids[owner], int(origin[a]), int(origin[b - 1]) + 1, e, x, y, m) for e, a, b, x, y in spans]
        if self.short:
            line = points.tobytes()
            for number, own in self.short:  # too short for a q-gram: exact places
                raw, k = own.tobytes(), line.find(own.tobytes())
                while k >= 0:
                    if k % 4 == 0:
                        out.append((number, int(origin[k // 4]), int(origin[k // 4 + len(own) - 1]) + 1, 0, 0, len(own), len(own)))
                    k = line.find(raw, k + (len(raw) if k % 4 == 0 else 1))
        return sorted(out)


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, one after another: they are the fixed query set of the search."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").filter("text is not null").orderBy("item_id", "text").toLocalIterator():
        if block and size + len(row["text"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def covered(docs: DataFrame, benchmark: DataFrame, q: int = GRAM, rate: float = EDIT_RATE) -> DataFrame:
    """``doc_id, item_id, start, stop, edits, item_start, item_stop, item_chars`` for each place where a document has a benchmark
    item or a part of it, of ``REGION`` characters at least: where it stands, and which of the item's characters it holds.

    Letter case and runs of white space do not count. Items shorter than ``q`` characters are found exactly; items with no
    text but white space and null items never. Null and empty documents have no places. Repeated documents and repeated
    items each give their rows; a null id is kept. Without items the result is empty. Documents are read once for each
    block of items, whole, with nothing shuffled.
    """
    columns = "hits array<struct<" + ", ".join(f"{n} long" for n in FIELDS) + ">>"
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in FIELDS]))
    texts, out = doc_texts(docs), None

    def reader_of(items: list[tuple[int, str]]):
        def reader():
            index = Index(items, q, rate)

            def read(batch: list[str]) -> list[pa.Array]:
                return [pa.array([[dict(zip(FIELDS, h, strict=True)) for h in index.regions(t)] for t in batch], kind)]

            return read

        return reader

    for items in item_blocks(benchmark):
        part = by_text(texts, reader_of(items), columns)
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = texts.limit(0).select("doc_id", F.lit(None).cast(columns.removeprefix("hits ")).alias("hits"))
    return out.select("doc_id", F.inline("hits"))


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = GRAM, rate: float = EDIT_RATE) -> DataFrame:
    """``doc_id, item_id, start, stop, edits`` of ``covered``."""
    return covered(docs, benchmark, q, rate).select("doc_id", *FIELDS[:4])


def without_leaks(docs: DataFrame, benchmark: DataFrame, q: int = GRAM, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item and no part of one that ``covered`` finds, with all their columns. Nothing is shuffled."""
    mark = unused("leaks", docs.columns)

    def reader_of(items: list[tuple[int, str]]):
        def reader():
            index = Index(items, q, rate)
            return lambda texts: [pa.array([bool(index.search(t)) for t in texts], pa.bool_())]

        return reader

    for items in item_blocks(benchmark):
        docs = by_text(docs, reader_of(items), f"{mark} boolean", tuple(docs.columns)).filter(~F.col(mark)).drop(mark)
    return docs
