"""Problem 8: text garbled by a wrong character encoding.

Each stretch of text without blanks that holds a character beyond ASCII (or an entity) is the start
of a best-first graph search.  Nodes are texts; an edge encodes a text in the encoding it was read
in and decodes the bytes in the one it was written in, replaces entities, puts back bytes that
were lost on the way and left a part of their character, or puts a character in the place of a
replacement character.  Nodes already seen are known by their hash and not opened again.  The
order is given by a cost: how implausible the characters are side by side, by pair counts over all
documents, plus a price for every edge.  The search ends when no open node is within SLACK of the
cheapest text reached.

What was read wrongly was read so in one way: the gains of the stretches of a document that the
same edges repair are added, and if they exceed the price of these edges by a margin, the stretches
are garbled.  A stretch with a sign of loss (U+FFFD, control characters) needs no margin: any more
plausible text that the search reaches tells that it is garbled.

Pair counts are taken over distinct texts, so copies of a garbled text do not make it plausible,
and hashed into tables of fixed size, so what is sent to the executors does not grow.  The search
depends on a stretch alone, so each distinct one is searched once for all documents.  The outcomes
of the most frequent ones are sent along with a Bloom filter of fixed size of all that have a more
plausible reading; the documents' own pass searches only what neither of these tells.
"""

from __future__ import annotations

import hashlib
import heapq
import html
import json
import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from labelmill.functions.storage import checkpointed
from labelmill.llm.parallel import spread

#: Bits of the two hash tables for pairs of characters and of those for single ones.
PAIR_BITS, SINGLE_BITS = 19, 16
#: Nats by which the gains of a document must exceed the price of their edges.
MARGIN = 1.5
#: Part of the price that counts while one stretch is searched; its whole is due once a document.
SEARCH_SHARE = 0.4
#: Nats by which an opened node may be dearer than the cheapest one so far (at first, the start).
SLACK = 4.0
#: A search that has opened so many nodes is given up: its best reading so far counts, and the
#: document is never called complete.  Over the test tables no search opens a thousand.
MOST_NODES = 100_000
#: Stretches whose outcome a worker remembers.
REMEMBERED = 200_000
#: Nats by which a guess must beat the next one to stand in the restored text.
SURE = 2.0
#: Guesses kept from one lost character of a run to the next.
BEAM = 16
#: Bits of the filter of stretches that have a more plausible reading.
FILTER_BITS = 23
#: Outcomes that are sent to all workers, and the length of their stretches: below 20 MB in all.
COMMON, COMMON_LENGTH = 50_000, 64

#: Encodings, the usual mistakes first; fixed values.
READ_FOR_UTF8 = ("cp1252", "latin-1", "cp1250", "iso8859-2", "iso8859-15", "cp1251", "koi8-r", "cp437", "cp850", "cp866", "mac-roman", "cp1253", "cp1254", "iso8859-7", "mac-cyrillic", "gb18030", "big5", "shift_jis", "euc-kr")
READ_FOR_BYTES = ("cp1252", "latin-1", "mac-roman", "cp437", "cp850", "cp1251", "koi8-r", "cp1250", "iso8859-2", "cp1253", "cp866", "gb18030")
BYTES = ("cp1252", "mac-roman", "cp437", "cp850", "cp1251", "koi8-r")
READ_FOR_WIDE, WIDE_BYTES = ("cp1252", "latin-1"), ("gb18030", "shift_jis", "big5", "euc-kr")
#: Edge (read in, written in) -> price in nats: UTF-8 is the usual case, others need more evidence.
#: Only one edge of a path may cost so much: most bytes are valid in any of these encodings, so two such edges prove nothing.
BYTES_PRICE = 4.0
EDGES = {(a, "utf-8"): 1.0 for a in READ_FOR_UTF8} | {(a, b): BYTES_PRICE for a in READ_FOR_BYTES for b in BYTES if a != b} | {(a, b): BYTES_PRICE for a in READ_FOR_WIDE for b in WIDE_BYTES}
UNESCAPE, RESTORE, GUESS = ("entities", ""), ("lost bytes", ""), ("replacement characters", "")
PRICES = EDGES | {UNESCAPE: 0.5, GUESS: 0.5}
#: Putting back a character costs this and minus the log of its share of all characters beyond ASCII.
RESTORE_PRICE = 3.0

ENTITY = regex.compile(r"&(?:[A-Za-z]{2,8}[0-9]{0,2}|#x?[0-9A-Fa-f]+);")
#: U+0085 is also a line end and no sign of loss by itself.
LOST = regex.compile(r"[�\x80-\x84\x86-\x9f]")
SIGNS_OF_LOSS = frozenset(c for c in map(chr, [*range(0x80, 0xA0), 0xFFFD]) if LOST.match(c))
#: Characters beyond ASCII that are more than a kind of blank.
SEEN = regex.compile(r"[^\x00-\x7f\p{Z}\u200b-\u200f\ufeff]")
START = re.compile(r"[^\x00-\x7f]|&")
WIDE = regex.compile(r"[^\x00-\x7f]+")
NEAR = regex.compile(r"(?s).[^\x00-\x7f]+.")
REPLACED = re.compile("\ufffd+")
DIGITS = regex.compile(r"[0-9]+(?:[.,][0-9]+)*")


def stretches(text: str) -> list[str]:
    """Parts between blanks that hold a character beyond ASCII or an entity."""
    if text.isascii() and "&" not in text:
        return []
    text, out, end = text.replace("\t", " ").replace("\r", " ").replace("\n", " "), [], -1
    for m in START.finditer(text):
        if m.start() > end:
            start, end = text.rfind(" ", 0, m.start()) + 1, text.find(" ", m.start())
            end = len(text) if end < 0 else end
            w = text[start:end]
            if SEEN.search(w) or ("&" in w and ENTITY.search(w)):
                out.append(w)
    return out


def shape(stretch: str) -> str:
    """The stretch with its numbers as 0: what plausibility and repair depend on."""
    return stretch if "&" in stretch else DIGITS.sub("0", stretch)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


#: Odd multipliers of the hash functions; fixed values.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX, _WORD = [np.uint64(m) for m in MULTIPLIERS], (1 << 64) - 1


def _slots(codes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places of the single characters and of the pairs of a text in both tables of each."""
    pairs = codes[:-1] << np.uint64(21) | codes[1:]
    mix = lambda x, m, bits: ((x * m ^ (x * m) >> np.uint64(29)) * m >> np.uint64(64 - bits)).astype(np.int64)
    return [mix(codes, m, SINGLE_BITS) for m in _MIX], [mix(pairs, m, PAIR_BITS) for m in _MIX]


def _slot(code: int, m: int, bits: int) -> int:
    """The place of one character or pair, as _slots gives it."""
    code = code * m & _WORD
    return ((code ^ code >> 29) * m & _WORD) >> 64 - bits


class Plausibility:
    """Cost of a text: minus the log of the chance of each character after the one before it.

    Signs of loss are nothing that anyone writes: they cost as if they had never been seen.
    """

    def __init__(self, singles: np.ndarray, pairs: np.ndarray) -> None:
        """Counts, shape (2, places): a count is the smaller one of its two places."""
        self.singles, self.pairs = singles, pairs
        self.total = max(1.0, float(singles[0].sum()))

        self.prices: dict[str, float] = {}

    def _count(self, c: str) -> float:
        return 0.0 if c in SIGNS_OF_LOSS else min(float(t[_slot(ord(c), m, SINGLE_BITS)]) for t, m in zip(self.singles, MULTIPLIERS))

    def _price(self, pair: str) -> float:
        a, b = pair
        both = 0.0 if a in SIGNS_OF_LOSS or b in SIGNS_OF_LOSS else min(float(t[_slot(ord(a) << 21 | ord(b), m, PAIR_BITS)]) for t, m in zip(self.pairs, MULTIPLIERS))
        return -math.log((both + 0.5 * (self._count(b) + 0.02) / (self.total + 2000)) / (self._count(a) + 0.5))

    def cost(self, text: str) -> float:
        """Only pairs with a character beyond ASCII cost: the others are the same in every reading."""
        if text.isascii():
            return 0.0
        text, total, prices = f" {text} ", 0.0, self.prices
        for m in NEAR.finditer(text):
            for i in range(m.start(), m.end() - 1):
                price = prices.get(pair := text[i : i + 2])
                total += self.price(pair) if price is None else price
        return total

    def price(self, pair: str) -> float:
        price = self.prices.get(pair)
        if price is None:
            if len(self.prices) > 4 * REMEMBERED:
                self.prices.clear()
            price = self.prices[pair] = self._price(pair)
        return price


#: Windows code pages leave bytes open; those are often passed on as they are.
_OPEN_PAGES = ("cp1252", "cp1250", "cp1251", "cp1253", "cp1254")


@lru_cache(maxsize=1 << 12)
def to_bytes(text: str, encoding: str) -> bytes | None:
    try:
        return text.encode(encoding)
    except UnicodeEncodeError:
        if encoding not in _OPEN_PAGES:
            return None
    out = bytearray()
    for c in text:
        try:
            out += c.encode(encoding)
        except UnicodeEncodeError:
            if not "\x80" <= c <= "\x9f":
                return None
            out.append(ord(c))
    return bytes(out)


def to_text(data: bytes, encoding: str) -> str | None:
    try:
        return data.decode(encoding)
    except UnicodeDecodeError:
        return None


def lossy_forms(alphabet: Iterable[str]) -> dict[str, list[tuple[str, str]]]:
    """What is left of characters whose UTF-8 was read in another encoding when bytes that mean
    nothing there were dropped or replaced: first character -> (what is left, character)."""
    forms = set()
    for c in alphabet:
        data = c.encode("utf-8", "ignore")
        for encoding in ("latin-1", "cp1252"):
            whole = [to_text(bytes([b]), encoding) or "" for b in data]
            left = "".join(x for x in whole if not "\x80" <= x <= "\x9f" and x != "\xa0")
            if len(left) < len(data):
                forms.add((left, c))
        for encoding in READ_FOR_UTF8:
            left = data.decode(encoding, "replace")
            if "\ufffd" in left and left.strip("\ufffd"):
                forms.add((left, c))
    by: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for left, c in sorted(forms, key=lambda x: (-len(x[0]), x)):
        if left and left != c:
            by[left[0]].append((left, c))
    return dict(by)


@lru_cache(maxsize=1 << 16)
def _byte(c: str, encoding: str) -> int:
    """The byte beyond ASCII that a character is in an encoding, or -1."""
    data = to_bytes(c, encoding)
    return data[0] if data and len(data) == 1 and data[0] > 127 else -1


def _sequences(text: str, encoding: str) -> str:
    """text with those sequences of characters read anew whose bytes are one character of UTF-8."""
    out, i, n = [], 0, len(text)
    while i < n:
        c = text[i]
        b = _byte(c, encoding) if c > "\x7f" else -1
        size = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
        if size and i + size <= n:
            data = [b, *(_byte(x, encoding) if x > "\x7f" else -1 for x in text[i + 1 : i + size])]
            whole = to_text(bytes(data), "utf-8") if min(data) > 0 else None
            if whole is not None:
                out.append(whole)
                i += size
                continue
        out.append(c)
        i += 1
    return "".join(out)


def _convert(text: str, a: str, b: str) -> str:
    """text read anew; if it cannot be as a whole, those parts that can."""
    data = to_bytes(text, a)
    whole = to_text(data, b) if data is not None else None
    if whole is not None:
        return whole
    if b == "utf-8" and a not in WIDE_BYTES:
        return _sequences(text, a)

    def part(m: regex.Match) -> str:
        data = to_bytes(m[0], a)
        return (to_text(data, b) if data is not None else None) or m[0]

    return WIDE.sub(part, text)


class Repairer:
    """Search over the ways in which a stretch may have come about."""

    def __init__(self, model: Plausibility, letters: dict[str, int], marked: np.ndarray | None = None, common: dict | None = None) -> None:
        """letters: characters beyond ASCII with their numbers; marked: a filter, see `marked_bits`;
        common: known outcomes."""
        self.model, self.marked, self.common = model, marked, common or {}
        letters = {c: n for c, n in letters.items() if c > "\x7f" and not LOST.search(c)}
        total = sum(letters.values())
        self.prices = {c: RESTORE_PRICE - math.log(n / total) for c, n in letters.items()}
        self.alphabet = sorted(letters, key=lambda c: (-letters[c], c))
        self.forms = lossy_forms(self.alphabet)
        self.known: dict[str, tuple[tuple, float, bool]] = {}
        self.guesses: dict[tuple[str, int, str], list[tuple[float, str]]] = {}

    def price(self, edge: tuple) -> float:
        return self.prices[edge[2]] if edge[0] == RESTORE[0] else PRICES[edge]

    def fill(self, before: str, n: int, after: str) -> list[tuple[float, str]]:
        """The likeliest n characters between two others, best first, with their costs."""
        key = before, n, after
        if (known := self.guesses.get(key)) is None:
            price, paths = self.model.price, [(0.0, "")]
            for _ in range(n):
                longer = [(cost + price((p or before)[-1] + c), p + c) for cost, p in paths for c in self.alphabet]
                paths = heapq.nsmallest(BEAM, longer)
            known = sorted((cost + price(p[-1] + after), p) for cost, p in paths if p)
            if len(self.guesses) > REMEMBERED:
                self.guesses.clear()
            self.guesses[key] = known
        return known

    def guess(self, text: str, sure: bool = False) -> str:
        """text with the likeliest characters in place of replacement characters; if `sure`, only
        where they are clearly likelier than any others."""
        framed = f" {text} "

        def put(m: re.Match) -> str:
            best = self.fill(framed[m.start() - 1], len(m[0]), framed[m.end()])
            if not best or (sure and len(best) > 1 and best[1][0] - best[0][0] < SURE):
                return m[0]
            return best[0][1]

        return REPLACED.sub(put, framed)[1:-1]

    def apply(self, text: str, edge: tuple) -> Iterator[tuple[tuple, str]]:
        """Texts that an edge leads to, each with the edge (and the characters put back)."""
        if edge == UNESCAPE:
            yield edge, html.unescape(text)
        elif edge == GUESS:
            if "\ufffd" in text:
                yield edge, self.guess(text)
        elif edge == RESTORE:
            for first in dict.fromkeys(text):
                for left, c in self.forms.get(first, ()):
                    if left in text:
                        yield (RESTORE[0], left, c), text.replace(left, c)
        elif edge[0] == RESTORE[0]:
            yield edge, text.replace(edge[1], edge[2])
        else:
            yield edge, _convert(text, *edge)

    def neighbours(self, text: str) -> Iterator[tuple[tuple, str, float]]:
        if "&" in text and ENTITY.search(text):
            edges = [UNESCAPE]
        elif text.isascii():
            return
        else:
            edges = [*EDGES, RESTORE, GUESS]
        for edge in edges:
            for exact, to in self.apply(text, edge):
                # What is plain ASCII was never garbled, and no repair may lose more than it had lost.
                if to and to != text and not to.isascii() and (not LOST.search(to) or LOST.search(text)):
                    yield exact, to, self.price(exact)

    def search(self, start: str) -> tuple[tuple, float, bool]:
        """The edges to the cheapest text reached, by how much it is more plausible, and whether
        the search came to its end.

        Entities are compared with the characters they stand for: to write one is no mistake.
        """
        meant = html.unescape(start) if "&" in start else start
        base = self.model.cost(meant)
        best, best_total, gain = (), base, 0.0
        seen = {hash(start)}
        heap = [(base, 0, start, (), 0.0)]
        opened = 0
        while heap:
            total, _, text, path, paid = heapq.heappop(heap)
            if total > best_total + SLACK:
                break
            opened += 1
            if opened > MOST_NODES:
                return best, gain, False
            dear = any(PRICES.get(e, 0) >= BYTES_PRICE for e in path)
            for edge, to, price in self.neighbours(text):
                if (key := hash(to)) in seen or (dear and PRICES.get(edge, 0) >= BYTES_PRICE):
                    continue
                seen.add(key)
                cost, due = self.model.cost(to), paid + SEARCH_SHARE * price
                if cost + due < best_total and to != meant:
                    best, best_total, gain = (*path, edge), cost + due, base - cost
                heapq.heappush(heap, (cost + due, len(seen), to, (*path, edge), due))
        return best, gain, True

    def judge(self, stretch: str) -> tuple[tuple, float, bool]:
        """Outcome of the search for the shape of a stretch; remembered."""
        key = shape(stretch)
        out = self.common.get(key) or self.known.get(key)
        if out is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            ruled_out = self.marked is not None and not is_marked(self.marked, key)
            out = self.known[key] = ((), 0.0, True) if ruled_out else self.search(key)
        return out

    def ways(self, text: str) -> tuple[dict[tuple, float], set[tuple], bool]:
        """Edges -> gains less price over the stretches of a text that they repair best; those that
        repair a sign of loss; and whether all searches came to their end."""
        gains: dict[tuple, float] = defaultdict(float)
        prices: dict[tuple, float] = {}
        lost, ended = set(), True
        for s in {shape(w) for w in stretches(text)}:
            path, gain, end = self.judge(s)
            ended &= end
            if path:
                kind, price = _kind(path), sum(map(self.price, path))
                gains[kind] += gain
                prices[kind] = min(price, prices.get(kind, price))
                if LOST.search(s):
                    lost.add(kind)
        return {k: g - prices[k] for k, g in gains.items()}, lost, ended

    def follow(self, text: str, path: tuple) -> str:
        """text after all edges of a path; guesses stand only where they are sure."""
        for edge in path:
            text = self.guess(text, True) if edge == GUESS else next((t for _, t in self.apply(text, edge)), text)
        return text

    def repair(self, text: str | None) -> tuple[bool, str | None, bool]:
        """Whether a text is garbled, the text with all repairs, and whether no sign of loss is left.

        A null text is not garbled, its repair is null.
        """
        if not text:
            return False, text, True
        gains, lost, ended = self.ways(text)
        wrong = {k for k, g in gains.items() if g >= MARGIN} | lost
        if not wrong:
            return False, text, True
        done: dict[str, str] = {}
        for w in set(stretches(text)):
            path, _, _ = self.judge(w)
            if path and _kind(path) in wrong:
                done[w] = self.follow(w, path)
                continue
            # What is known to have gone wrong elsewhere in the text needs no more evidence here.
            for kind in sorted(wrong):
                to = self.follow(w, kind) if RESTORE not in kind and GUESS not in kind else w
                # To be valid UTF-8 is evidence by itself; of other encodings the result must be likelier.
                if to != w and (all(e[1] in ("utf-8", "") for e in kind) or self.model.cost(shape(to)) < self.model.cost(shape(w))):
                    done[w] = to
                    break
        parts = regex.split(r"([ \t\r\n])", text)
        out = "".join(done.get(p, p) for p in parts)
        return True, out, ended and "\ufffd" not in text and LOST.search(out) is None


def _kind(path: tuple) -> tuple:
    """The edges of a path without the characters that were put back."""
    return tuple(RESTORE if e[0] == RESTORE[0] else e for e in path)


def _shapes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        rows = []
        for text in pdf["text"]:
            if text and (found := stretches(text)):
                digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
                rows.append((digest, [shape(w) for w in found]))
        yield pd.DataFrame(rows, columns=["digest", "shapes"])


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shapes of a partition with their numbers, added up as far as memory allows."""
    held: Counter[str] = Counter()
    for pdf in frames:
        for shapes in pdf["shapes"]:
            held.update(shapes)
        if len(held) > REMEMBERED:
            yield pd.DataFrame({"shape": list(held), "n": list(held.values())})
            held.clear()
    if held:
        yield pd.DataFrame({"shape": list(held), "n": list(held.values())})


def _tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of a partition: tables 0 and 1 singles, 2 and 3 pairs, 4 characters."""
    tables = [np.zeros(1 << bits, np.int64) for bits in (SINGLE_BITS, SINGLE_BITS, PAIR_BITS, PAIR_BITS)]
    letters: Counter[str] = Counter()
    for pdf in frames:
        for s, n in zip(pdf["shape"], pdf["n"]):
            one, two = _slots(_codes(s))
            for t, at in zip(tables, [*one, *two]):
                np.add.at(t, at, n)
            for c in s:
                if c > "\x7f":
                    letters[c] += n
    for k, t in enumerate(tables):
        at = np.flatnonzero(t)
        yield pd.DataFrame({"kind": k, "place": at, "n": t[at]})
    yield pd.DataFrame({"kind": 4, "place": [ord(c) for c in letters], "n": list(letters.values())}, dtype=np.int64)


def distinct_shapes(documents: DataFrame, text: str) -> DataFrame:
    """shape and n: the stretches of all distinct texts, each once, with their numbers."""
    shapes = spread(documents.select(F.col(f"`{text}`").alias("text"))).mapInPandas(_shapes, "digest string, shapes array<string>")
    counted = shapes.dropDuplicates(["digest"]).select("shapes").mapInPandas(_count, "shape string, n long")
    return checkpointed(counted.groupBy("shape").agg(F.sum("n").alias("n")))


def learn(shapes: DataFrame) -> tuple[Plausibility, dict[str, int]]:
    """Pair counts over all shapes, and the characters beyond ASCII with their numbers.

    What reaches the driver is at most one number for each place of the tables and for each
    character of Unicode.
    """
    counts = shapes.mapInPandas(_tally, "kind long, place long, n long").groupBy("kind", "place").agg(F.sum("n").alias("n")).toPandas()
    singles, pairs = np.zeros((2, 1 << SINGLE_BITS)), np.zeros((2, 1 << PAIR_BITS))
    for table, k in ((singles[0], 0), (singles[1], 1), (pairs[0], 2), (pairs[1], 3)):
        own = counts[counts["kind"] == k]
        table[own["place"].to_numpy(np.int64)] = own["n"].to_numpy(float)
    own = counts[counts["kind"] == 4].sort_values("place")
    return Plausibility(singles.astype(np.float32), pairs.astype(np.float32)), dict(zip(map(chr, own["place"]), map(int, own["n"])))


def bits_of(key: str) -> tuple[int, int]:
    """Two places of the filter for a shape."""
    h = int.from_bytes(hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return h & (1 << FILTER_BITS) - 1, h >> 32 & (1 << FILTER_BITS) - 1


def is_marked(marked: np.ndarray, key: str) -> bool:
    return all(marked[i >> 3] >> (i & 7) & 1 for i in bits_of(key))


def outcomes(shapes: DataFrame, make: Callable[[], Repairer]) -> DataFrame:
    """shape, n, path, gain and ended of the shapes that have a more plausible reading, or whose
    search was given up, with their places in the filter (bits); each is searched once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repairer = make()
        for pdf in frames:
            rows = []
            for s, n in zip(pdf["shape"], pdf["n"]):
                path, gain, ended = repairer.search(s)
                if path or not ended:
                    rows.append((s, n, json.dumps(path), gain, ended, list(bits_of(s))))
            if rows:
                yield pd.DataFrame(rows, columns=["shape", "n", "path", "gain", "ended", "bits"])

    return checkpointed(spread(shapes).mapInPandas(run, "shape string, n long, path string, gain double, ended boolean, bits array<long>"))


def marked_bits(found: DataFrame) -> np.ndarray:
    """The filter of the shapes of `outcomes`.

    At most one number for each bit reaches the driver; the more bits are set, the more shapes are
    searched again, and none is missed.
    """
    bits = found.select(F.explode("bits").alias("bit")).distinct().toPandas()["bit"].to_numpy(np.int64)
    flags = np.zeros(1 << FILTER_BITS, np.uint8)
    flags[bits] = 1
    return np.packbits(flags, bitorder="little")


def common_outcomes(found: DataFrame) -> dict[str, tuple[tuple, float, bool]]:
    """The outcomes of the most frequent shapes, at most COMMON of them and none longer than
    COMMON_LENGTH, so that workers need not search these; all others they search themselves."""
    short = found.filter((F.length("shape") <= COMMON_LENGTH) & (F.length("path") <= 4 * COMMON_LENGTH))
    rows = short.orderBy(F.desc("n"), "shape").limit(COMMON).select("shape", "path", "gain", "ended").toPandas()
    return {s: (tuple(map(tuple, json.loads(p))), g, e) for s, p, g, e in rows.itertuples(index=False)}


#: The repairer of a worker, by the run it belongs to.
_REPAIRERS: dict[str, Repairer] = {}


def _held(number: str, shared, *more) -> Callable[[], Repairer]:
    """A function that gives a worker's repairer, made of broadcast parts when it is first asked for."""

    def make() -> Repairer:
        if number not in _REPAIRERS:
            _REPAIRERS.clear()
            singles, pairs, letters = shared.value
            _REPAIRERS[number] = Repairer(Plausibility(singles, pairs), letters, *[m.value for m in more])
        return _REPAIRERS[number]

    return make


def repair_texts(documents: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """keep, garbled, restored and complete for every document.

    restored is the text with the repairs that were found; complete says that no search was given
    up and that there was no replacement character (what stands in its place is a guess) and no
    other sign of loss is left.  Null, empty and blank texts are not garbled.  The result depends on the other documents only through the
    pair counts.
    """
    shapes = distinct_shapes(documents, text)
    model, letters = learn(shapes)
    context = documents.sparkSession.sparkContext
    shared = context.broadcast((model.singles, model.pairs, letters))
    searched = outcomes(shapes, _held(uuid.uuid4().hex, shared))
    make, n = _held(uuid.uuid4().hex, shared, context.broadcast(marked_bits(searched)), context.broadcast(common_outcomes(searched))), len(keep)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repairer = make()
        for pdf in frames:
            found = [repairer.repair(x if isinstance(x, str) else None) for x in pdf.iloc[:, n]]
            yield pdf.iloc[:, :n].assign(**{"garbled": [x[0] for x in found], "restored": [x[1] for x in found], "complete": [x[2] for x in found]})

    own = spread(documents.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias(f"c{n}")))
    schema = T.StructType([*own.schema.fields[:n], T.StructField("garbled", T.BooleanType()), T.StructField("restored", T.StringType()), T.StructField("complete", T.BooleanType())])
    return own.mapInPandas(run, schema).withColumnsRenamed({f"c{i}": c for i, c in enumerate(keep)})
