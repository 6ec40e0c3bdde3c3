"""Token counts by a compiled finite-state transducer.

The vocabulary of a piece-wise BPE model (a sentencepiece ``.model`` without
normaliser, with dummy prefix and byte fallback) is compiled, transition by
transition as texts need it, into a deterministic transducer over characters.
A state holds the piece starts that are still open and the last piece of the
segmentation that ends there; a transition carries how many tokens the
segmentation gains. Two pieces may stand side by side exactly when merging the
two alone gives them back, so the last piece before each position decides the
state and no merge has to be replayed over the text.

Texts are cut into chunks. A chunk's state map is (head, count, tail): between
its first and last word boundary the start state doesn't matter, so the count
there is fixed, and the state at either edge is named by the characters since
the boundary. Maps compose associatively: a batch composes the chunks that it
holds of a document, and a document what its batches gave, in order. Only maps
are shuffled; a stretch without a boundary is its own map, so text without
spaces goes along as it stands.

What is compiled stays with the Python worker, by vocabulary, and serves the
tasks that come after.

Defined results: a null text counts as empty, an empty text has no tokens; rows
that repeat are counted one by one; a null id stays null.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from functools import reduce
from itertools import groupby, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import map_batches, sorted_groups

#: Characters of a chunk, and states or words that a worker holds at most (beyond it, states start anew and the older half of the words goes).
CHUNK, STATES, WORDS = 1 << 15, 200_000, 200_000
SPACE = "▁"


class Transducer:
    """Counts the tokens of words; a word is a run without spaces, with a leading SPACE or without."""

    def __init__(self, pieces: dict[str, float]):
        self.score = pieces
        self.open = {p[:i] for p in pieces for i in range(1, len(p))}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.runs: dict[int, int] = {}
        self.compile()

    def compile(self) -> None:
        """Only the start state; the others follow as texts reach them."""
        self.ids: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.next: list[dict[str, tuple[int, int]]] = []
        self.start = self.state((("", None, 0),))

    def state(self, key: tuple) -> int:
        if key not in self.ids:
            self.ids[key] = len(self.keys)
            self.keys.append(key)
            self.next.append({})
        return self.ids[key]

    def merge(self, symbols: list[str]) -> list[str]:
        """Segments characters by merging the best scored pair, the leftmost of equals, until none is a piece."""
        sym, nxt, prv = list(symbols), [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (s := self.score.get(sym[i] + sym[j])) is not None:
                heapq.heappush(heap, (-s, i, j, sym[i] + sym[j]))

        for i in range(len(sym) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, piece = heapq.heappop(heap)
            if nxt[i] != j or not sym[i] or sym[i] + sym[j] != piece:
                continue
            sym[i], sym[j] = piece, ""
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            offer(prv[i], i)
            offer(i, nxt[i])
        return [s for s in sym if s]

    def beside(self, left: str | None, right: str) -> bool:
        """Whether ``right`` can follow ``left``: merging both gives the two back."""
        key = (left or "", right)
        if key not in self.pairs:
            if len(self.pairs) >= STATES:
                self.pairs.clear()
            self.pairs[key] = self.merge(list(key[0] + right)) == [x for x in key if x]
        return self.pairs[key]

    def step(self, state: int, c: str) -> tuple[int, int]:
        """The transition: the next state and the tokens gained."""
        if c not in self.score:  # bytes; nothing merges across them
            out = (self.start, len(c.encode()))
        else:
            best, still = None, []
            for suffix, last, n in self.keys[state]:
                grown = suffix + c
                if best is None and grown in self.score and self.beside(last, grown):
                    best = (grown, n + 1)
                if grown in self.open:
                    still.append((grown, last, n))
            piece, gained = best
            out = (self.state((*[(s, last, n - gained) for s, last, n in still], ("", piece, 0))), gained)
        self.next[state][c] = out
        return out

    def word(self, word: str) -> int:
        if len(self.keys) > STATES:
            self.compile()
        state, total, table = self.start, 0, self.next
        for c in word:
            to = table[state].get(c) or self.step(state, c)
            state = to[0]
            total += to[1]
        return total

    def alone(self, word: str) -> bool:
        """Whether the leading SPACE of a word stays a token of its own."""
        return len(word) == 1 or word[1] not in self.score or self.word(word) == self.word(word[1:]) + 1 and self.merge(list(word))[0] == SPACE

    def run(self, n: int) -> int:
        """Tokens of ``n`` spaces that nothing merges with."""
        if n not in self.runs:
            if len(self.runs) >= STATES:
                self.runs.clear()
            self.runs[n] = len(self.merge([SPACE] * n))
        return self.runs[n]


class Words(dict):
    """Composed transitions: from the start state over a whole word."""

    def __init__(self, t: Transducer):
        super().__init__()
        self.t = t

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS:
            for old in [*islice(self, WORDS // 2)]:
                del self[old]
        n = self[word] = self.t.word(word)
        return n


class Counter:
    """Tokens of segments that start at a word boundary, and chunk state maps."""

    def __init__(self, model: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model)
        usable = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.t = Transducer({m.id_to_piece(i): m.get_score(i) for i in usable})
        self.bare, self.spaced = Words(self.t), Words(self.t)

    def segment(self, s: str) -> int:
        """``s`` without SPACE characters; a space is a boundary, a line end one token."""
        lines = s.split("\n")
        total = len(lines) - 1
        for line in lines:
            bare, *rest = line.split(" ")
            total += self.bare[bare]
            if "" in rest:
                total += self.spread(rest)
            else:
                total += sum(map(self.spaced.__getitem__, [SPACE + w for w in rest]))
        return total

    def spread(self, parts: list[str]) -> int:
        """Parts that follow a space each, with runs of spaces among them."""
        total = run = 0
        for p in parts:
            run += 1
            if p:
                w = SPACE + p
                n = self.spaced[w]
                total += n if run == 1 else self.t.run(run) + n - 1 if self.t.alone(w) else self.t.run(run - 1) + n
                run = 0
        return total + (self.t.run(run) if run else 0)

    def chunk(self, s: str) -> tuple[str, int | None, str]:
        """(head, count, tail); without a boundary inside, count is None and head the whole chunk."""
        first = next((i for i in self.boundaries(s)), None)
        if first is None:
            return s, None, ""
        last = next(i for i in self.boundaries(s, True))
        return s[:first], self.segment(s[first:last]), s[last:]

    @staticmethod
    def boundaries(s: str, back: bool = False):
        """Positions of spaces that follow another character, from the left or the right."""
        i = s.rfind(" ") if back else s.find(" ", 1)
        while i > 0:
            if s[i - 1] != " ":
                yield i
            i = s.rfind(" ", 0, i) if back else s.find(" ", i + 1)


Map = tuple[str, int | None, str]


def join(counter: Counter, left: Map, right: Map) -> Map:
    """The map of two stretches in a row."""
    (head, count, tail), (head_2, count_2, tail_2) = left, right
    if count is None:
        return head + head_2, count_2, tail_2
    if count_2 is None:
        return head, count, tail + head_2
    return head, count + counter.segment(tail + head_2) + count_2, tail_2


def joined(counter: Counter, maps: Iterable[Map]) -> Map:
    return reduce(lambda a, b: join(counter, a, b), maps, ("", None, ""))


def compose(counter: Counter, maps: Iterable[Map]) -> int:
    """The count of the stretches' maps in order, from the start of a text."""
    head, count, tail = joined(counter, maps)
    return sum(counter.segment(s) for s in (head, tail) if s) + (count or 0)


_COUNTERS: dict[str, Counter] = {}


def counter_of(model: str) -> Counter:
    """This worker's counter for a vocabulary."""
    if model not in _COUNTERS:
        _COUNTERS[model] = Counter(model)
    return _COUNTERS[model]


def count_tokens(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", limit: int = 4096, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens (as the library encodes the whole text), over_limit (more than ``limit``)."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.octet_length(t).cast("long").alias("n_bytes"), t.alias("text"))
    # the dummy prefix, and the escape of a space, which a text may also hold as such
    spaced = F.when(F.col("text") == "", F.lit("")).otherwise(F.translate(F.concat(F.lit(" "), F.col("text")), SPACE, " "))
    chunks = rows.select("row", "doc_id", "n_bytes", F.posexplode_outer(F.regexp_extract_all(spaced, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))).alias("no", "chunk"))

    def maps():
        counter = counter_of(model)

        def one(row, ids, n_bytes, no, texts):
            out = {c: [] for c in ("row", "doc_id", "n_bytes", "no", "head", "count", "tail")}
            held = zip(row.to_pylist(), ids.to_pylist(), n_bytes.to_pylist(), no.to_pylist(), texts.to_pylist(), strict=True)
            for r, chunks in groupby(held, key=lambda c: c[0]):
                chunks = list(chunks)
                made = joined(counter, (counter.chunk(c[4]) for c in chunks if c[4]))
                for name, value in zip(out, (r, *chunks[0][1:4], *made), strict=True):
                    out[name].append(value)
            return out

        return one

    parts = map_batches(chunks, "row long, doc_id long, n_bytes long, no int, head string, count long, tail string", maps)

    def whole(key, rows):
        n = compose(counter_of(model), (r[3:] for r in rows))
        yield rows[0][0], rows[0][1], n, n > limit

    return sorted_groups(parts, ["row"], ["no"], "doc_id long, n_bytes long, n_tokens long, over_limit boolean", whole)
