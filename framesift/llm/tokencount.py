"""Token counts of a BPE vocabulary with byte fallback, by a compiled finite-state transducer.

The encoding of a text is determined by the last token at each of its positions: token t can follow token s exactly if
the encoding of s + t is s, t. A state of the transducer is therefore what can still matter: the longest suffix read
that begins a piece, with the last token and the count at each position in it. Its transitions carry the change of the
token count. States are made when they are first reached, as in a lazy DFA; the machine is emptied when it has grown to
a bound, which changes no count. No piece holds a word mark (U+2581) behind another character, so that the machine is
in its start state before each run of marks: chunks of a text compose from what precedes their first mark, the count
between, and what follows their last.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.llm.common import kept_in_process, table

MARK = "▁"
CHUNK = 1 << 16  # characters of a text that become one chunk map
LIMIT = 4096


class Transducer:
    """Counts the tokens of one segment: a run of marks and the characters up to the next one."""

    MOST_STATES, MOST_WORDS, LONG = 200_000, 300_000, 48

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.begins = {p[:k] for p in scores for k in range(len(p) + 1)}
        self.longest = max(map(len, scores))
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}
        self.fits.clear()
        self.start = self._state(("", (None,), (0,)))

    def _state(self, key: tuple) -> int:
        if key not in self.states:
            self.states[key] = len(self.keys)
            self.keys.append(key)
        return self.states[key]

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: the best scored pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _can_follow(self, s: str | None, t: str) -> bool:
        key = (s or "", t)
        if key not in self.fits:
            self.fits[key] = self.merged((s or "") + t) == ([s, t] if s else [t])
        return self.fits[key]

    def cost(self, token: str) -> int:
        return 1 if token in self.scores else len(token.encode("utf-8", "surrogatepass"))

    def _step(self, state: int, c: str) -> tuple[int, int]:
        suffix, tokens, counts = self.keys[state]
        text = suffix + c
        for k in range(min(len(text), self.longest), 0, -1):
            t = text[-k:]
            before = len(tokens) - k  # place of the position in front of t
            if before >= 0 and (k == 1 or t in self.scores) and self._can_follow(tokens[before], t):
                break
        else:
            raise AssertionError("no token fits")
        here = counts[before] + self.cost(t)
        kept = text
        while kept not in self.begins:
            kept = kept[1:]
        n = len(kept) + 1
        tokens, counts = (*tokens, t)[-n:], (*counts, here)[-n:]
        to = self._state((kept, tokens, tuple(x - here for x in counts)))
        self.steps[state, c] = to, here
        return to, here

    def run(self, segment: str) -> int:
        if len(self.keys) > self.MOST_STATES:
            self.clear()
        state, n, steps = self.start, 0, self.steps
        for c in segment:
            x = steps.get((state, c))
            if x is None:
                x = self._step(state, c)
                if len(self.keys) > self.MOST_STATES:  # a long segment of ever new states: go on from this one
                    key = self.keys[x[0]]
                    self.clear()
                    steps, x = self.steps, (self._state(key), x[1])
            state = x[0]
            n += x[1]
        return n

    def word(self, w: str) -> int:
        """The count of a segment of one mark and w."""
        n = self.words.get(w)
        if n is None:
            n = self.run(MARK + w)
            if len(w) <= self.LONG:
                if len(self.words) >= self.MOST_WORDS:
                    self.words.clear()
                self.words[w] = n
        return n


def chunk_map(machine: Transducer, chunk: str) -> tuple[str, int | None, str]:
    """(what ends the segment before, count of whole segments, what begins the next); count None if there is no mark."""
    lead, *rest = chunk.split(MARK)
    if not rest:
        return lead, None, ""
    *whole, tail = rest
    if "" not in rest:
        known, n = machine.words, 0
        for w in whole:
            n += known[w] if w in known else machine.word(w)
        return lead, n, MARK + tail
    n, marks = 0, 0
    for w in whole:
        marks += 1
        if w:
            n += machine.word(w) if marks == 1 else machine.run(MARK * marks + w)
            marks = 0
    return lead, n, MARK * (marks + 1) + tail


def composed(machine: Transducer, x: tuple, y: tuple) -> tuple:
    """The map of chunk x and then chunk y. Associative."""
    if y[1] is None:
        return (x[0] + y[0], None, "") if x[1] is None else (x[0], x[1], x[2] + y[0])
    if x[1] is None:
        return x[0] + y[0], y[1], y[2]
    open_, lead = x[2], y[0]
    if not lead and not open_.strip(MARK):  # a run of marks may go on in y
        first = y[2]
        if y[1] == 0 and not first.strip(MARK):
            return x[0], x[1], open_ + first
    return x[0], x[1] + machine.run(open_ + lead) + y[1], y[2]


def count(machine: Transducer, text: str, chunk: int = CHUNK) -> int:
    """Tokens of a text: its chunks' maps, composed pairwise level by level."""
    if not text:
        return 0
    marked = MARK + text.replace(" ", MARK)
    cuts = [0]
    while cuts[-1] < len(marked):  # a run of marks is not cut
        at = min(len(marked), cuts[-1] + chunk)
        while at < len(marked) and marked[at] == MARK:
            at += 1
        cuts.append(at)
    maps = [chunk_map(machine, marked[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    while len(maps) > 1:
        maps = [composed(machine, *maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    lead, n, tail = maps[0]
    return (n or 0) + machine.run(tail)


def pieces_of(model: bytes) -> dict[str, float]:
    """Piece and score of the ordinary pieces of a sentencepiece BPE model."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_proto=model)
    return {m.id_to_piece(i): m.get_score(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))}


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """docs(doc_id, text) to (doc_id, n_bytes, n_tokens, over_limit), a row for each row, repeated ones too.

    Null texts count as empty: 0 bytes, 0 tokens. Other columns are ignored; no rows give no rows. The vocabulary file
    (some MB at most, whatever the data) goes to the executors with the function.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    assert len(model) < 64 << 20, "the vocabulary is sent to every task"
    digest = hash(model)
    shared = docs.sparkSession.sparkContext.broadcast(pieces_of(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = kept_in_process("transducer", digest, lambda: Transducer(shared.value))
        for batch in batches:
            n = [count(machine, t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of all documents under piece_bpe_32k.model: see token_counts()."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
