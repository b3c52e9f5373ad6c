"""Problem 6: byte-pair encoding by a lazily determinised finite-state transducer.

The encoding of every prefix of a word ends in one definite token, and a token u may follow a
token t exactly if no merge across their border comes before the merges that build t and u.  That
makes encoding a nondeterministic transducer over bytes whose places are pairs (place in the trie
of tokens, token before it), one pair for each start that may still become a token.  A step reads
one byte, moves every pair down the trie, and where a pair stands on a whole token that may follow
the one before it, that token is the last of the prefix read so far and opens a start of its own.

It is determinised as it is used.  A state is a set of pairs, each with the tokens that are known
to come before its start and have not been emitted yet.  What these tokens have in common at their
front no continuation can change, so the step emits it and the state keeps the rest.  Only starts
no further back than the longest token are open, so the rests, the states and the lookahead are
bounded.  States are numbered when they are first met and steps are computed when they are first
taken: only the part of the machine that the texts visit is ever built.  At the end of a word the
rest of the start that lies there is emitted.

Words come from the tokenizer's own pattern, which no token crosses.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from labelmill.functions.names import free_name
from labelmill.llm.parallel import spread

#: The pattern of byte-level BPE of this vocabulary: fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A run of white space (as the pattern sees it) and what follows up to the next one: words of the
#: pattern never reach across its ends, so its ids do not depend on what is around it.
_SPACE = "".join(map(regex.escape, regex.findall(r"\s", "".join(map(chr, range(0x3001))))))
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")

#: States and remembered chunks of a transducer; when there are more, they are built anew.
MAX_STATES, MAX_CHUNKS = 100_000, 200_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, and the merge that makes each."""

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        self.ids = ids
        self.bytes = {i: b for b, i in ids.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for r, (a, b) in enumerate(merges):
            pair, whole = (ids[a], ids[b]), ids[a + b]
            self.rank[pair] = r
            if whole not in self.parts:
                self.parts[whole], self.born[whole] = pair, r

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        """A `tokenizers` file of kind byte-level BPE."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        return cls({raw(s): i for s, i in model["vocab"].items()}, [(raw(a), raw(b)) for a, b in pairs])

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one edge (0 left, 1 right) while `token` is built, with the rank of the
        merge that ends each one; smallest first."""
        out, until = [], 1 << 60
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out[::-1]
            until = self.born[token]
            token = self.parts[token][side]


class Transducer:
    """Encodes words of one vocabulary; see the module's text."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.next: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for data, i in vocabulary.ids.items():
            if data and (len(data) == 1 or i in vocabulary.parts):
                node = 0
                for b in data:
                    node = self._child(node, b)
                self.token[node] = i
        self.edges: dict[tuple[int, int], bool] = {}
        self.left: dict[int, list] = {}
        self.right: dict[int, list] = {}
        self.chunks: dict[str, array] = {}
        self.pattern = regex.compile(PATTERN)
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        #: For each state: byte -> the next state and the tokens emitted on the way there.
        self.steps: list[dict[int, tuple[int, tuple]]] = []
        #: What a word that ends in a state has yet to emit.
        self.rests: list[tuple] = []
        self._forget()

    def _child(self, node: int, b: int) -> int:
        at = self.next[node].get(b)
        if at is None:
            at = self.next[node][b] = len(self.next)
            self.next.append({})
            self.token.append(-1)
        return at

    def _forget(self) -> None:
        """Only the start is left: one open start, before which there is no token."""
        start = ((0, -1, ()),)
        self.states[:] = [start]
        self.number.clear()
        self.number[start] = 0
        self.steps[:] = [{}]
        self.rests[:] = [()]

    def follows(self, t: int, u: int) -> bool:
        """Whether u may stand right after t."""
        if t < 0:
            return True
        known = self.edges.get((t, u))
        if known is None:
            known = self.edges[t, u] = self._follows(t, u)
        return known

    def _follows(self, t: int, u: int) -> bool:
        # The last part of t and the first part of u exist side by side until the next merge inside
        # either.  A merge of the two comes first if its rank is lower; at equal rank the merge
        # further left comes first, which is the one inside t but not the one inside u.
        if t not in self.right:
            self.right[t] = self.vocabulary.spine(t, 1)
        if u not in self.left:
            self.left[u] = self.vocabulary.spine(u, 0)
        a, b, rank = self.right[t], self.left[u], self.vocabulary.rank
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            across = rank.get((x, y))
            if across is not None and across < x_until and across <= y_until:
                return False
            if i == len(a) - 1 and j == len(b) - 1:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _step(self, state: int, b: int) -> tuple[int, tuple]:
        moved, last = [], None
        for node, before, rest in self.states[state]:
            at = self.next[node].get(b)
            if at is None:
                continue
            if self.next[at]:
                moved.append((at, before, rest))
            if (token := self.token[at]) >= 0 and self.follows(before, token):
                last = (0, token, (*rest, token))
        moved.append(last)
        rests = [rest for _, _, rest in moved]
        shared = 0
        for tokens in zip(*rests):
            if len(set(tokens)) > 1:
                break
            shared += 1
        out = rests[-1][:shared]
        key = tuple((node, before, rest[shared:]) for node, before, rest in moved)
        to = self.number.get(key)
        if to is None:
            if full := len(self.states) >= MAX_STATES:
                self._forget()
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            self.rests.append(key[-1][2])
            if full:  # the state that the step left is no longer known
                return to, out
        self.steps[state][b] = to, out
        return to, out

    def read(self, data: Iterable[bytes]) -> Iterator[int]:
        """Ids of one word that arrives in pieces, each as soon as no continuation can change it."""
        state, steps = 0, self.steps
        for piece in data:
            for b in piece:
                step = steps[state].get(b)
                state, out = step if step is not None else self._step(state, b)
                if out:
                    yield from out
        yield from self.rests[state]

    def encode_chunk(self, chunk: str) -> array:
        """Ids of a chunk; those of short chunks are remembered."""
        ids = array("i", (i for w in self.pattern.findall(chunk) for i in self.read((w.encode("utf-8", "surrogatepass"),))))
        if len(self.edges) > 4 * MAX_STATES:
            self.edges.clear()
        if len(chunk) <= 64:
            if len(self.chunks) > MAX_CHUNKS:
                self.chunks.clear()
            self.chunks[chunk] = ids
        return ids

    def parts(self, text: str) -> Iterator[array]:
        """Ids of a text, chunk by chunk."""
        known, encode = self.chunks.get, self.encode_chunk
        for chunk in _CHUNK.findall(text):
            ids = known(chunk)
            yield ids if ids is not None else encode(chunk)

    def encode(self, text: str) -> array:
        out = array("i")
        for ids in self.parts(text):
            out += ids
        return out

    def count(self, text: str) -> int:
        return sum(map(len, self.parts(text)))


class Utf8Reader:
    """Bytes to text as they come: an automaton over UTF-8 (Unicode table 3-7).

    State: how many continuation bytes are missing, and the range of the next one.  A sequence that
    breaks off gives U+FFFD for its longest valid beginning, as Python's decoder does.
    """

    def __init__(self) -> None:
        self.missing, self.low, self.high, self.code = 0, 0x80, 0xBF, 0

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.missing:
                if self.low <= b <= self.high:
                    self.code = self.code << 6 | b & 0x3F
                    self.missing -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.missing:
                        out.append(chr(self.code))
                    continue
                out.append("�")
                self.missing, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.missing, self.code = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.missing, self.code = 2, b & 0x0F
                self.low, self.high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
            elif 0xF0 <= b <= 0xF4:
                self.missing, self.code = 3, b & 0x07
                self.low, self.high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def close(self) -> str:
        left, self.missing, self.low, self.high = self.missing, 0, 0x80, 0xBF
        return "�" if left else ""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One transducer for each vocabulary file and process; tasks of a worker share what it has built."""
    if path not in _LOADED:
        _LOADED[path] = Transducer(Vocabulary.from_file(path))
    return _LOADED[path]


def decode(ids: list[int], path: str) -> str:
    """Text of token ids; ids that the vocabulary lacks give nothing."""
    known, reader = transducer(path).vocabulary.bytes, Utf8Reader()
    return "".join(reader.feed(known.get(i, b"")) for i in ids) + reader.close()


class _Encode:
    def __init__(self, path: str, lengths: bool) -> None:
        self.path, self.lengths = path, lengths

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(self.path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            if self.lengths:
                new = pa.array([t.count(x) if x else 0 for x in texts], pa.int64())
            else:
                ids, ends = array("i"), [0]
                for x in texts:
                    for part in t.parts(x or ""):
                        ids += part
                    ends.append(len(ids))
                new = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], new], names=[str(i) for i in range(batch.num_columns)])


def _encoded(df: DataFrame, text: str, keep: list[str], name: str, path: str | None, lengths: bool) -> DataFrame:
    own = spread(df.select(*[F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(keep)], F.col(f"`{text}`").alias(str(len(keep)))))
    kind = T.LongType() if lengths else T.ArrayType(T.IntegerType())
    schema = T.StructType([*own.schema.fields[:-1], T.StructField(str(len(keep)), kind)])
    return own.mapInArrow(_Encode(path or default_path(), lengths), schema).toDF(*keep, free_name(name, keep))


def encode_texts(df: DataFrame, text: str, keep: list[str], path: str | None = None, name: str = "ids") -> DataFrame:
    """The columns `keep` of df and the token ids of each text, without special tokens.

    An empty text and a null text give an empty list.  A name among `keep` gets its own column;
    `name` gets underscores if it clashes.  Strings of special tokens are ordinary text.
    """
    return _encoded(df, text, keep, name, path, False)


def count_tokens(df: DataFrame, text: str, keep: list[str], path: str | None = None, name: str = "n_tokens") -> DataFrame:
    """As encode_texts, with the number of ids in place of the ids."""
    return _encoded(df, text, keep, name, path, True)


def check_round_trip(df: DataFrame, text: str, keep: list[str], path: str | None = None) -> DataFrame:
    """keep, n_bytes and whether decoding the ids gives the text back (null text: as empty)."""
    at = path or default_path()

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(len(x.encode()), decode(transducer(at).encode(x), at) == x) for x in pdf["text_"].fillna("")]
            yield pd.concat([pdf.drop(columns="text_"), pd.DataFrame(rows, columns=["n_bytes", "same"], index=pdf.index)], axis=1)

    own = spread(df.select(*keep, F.col(text).alias("text_")))
    schema = T.StructType([*own.schema.fields[:-1], T.StructField("n_bytes", T.LongType()), T.StructField("same", T.BooleanType())])
    return own.mapInPandas(check, schema)
