"""Token counts from a compiled tokenizer, without building token lists.

A byte-fallback BPE vocabulary is compiled, as texts need it, to a deterministic transducer over
characters.  Every transition carries the change of the number of tokens, so the number of tokens
of a text is the sum along its path.

* The last token of a prefix is the only vocabulary token t that ends there, encodes to itself and
  forms a stable pair with the last token before it.  (A pair is stable if encoding the two
  strings together gives the two tokens back; stable neighbours make the whole encoding.)
* A state holds, for every place where a longer token may have begun, the place in the vocabulary
  trie, the last token before it and the number of tokens since.  That is all the future depends
  on; it is bounded by the longest token.
* No vocabulary token has a word mark after another character, and none has an unknown character.
  The path is back in a known state at each such place, so what lies between two of them is
  counted once and remembered.  It is also known behind a character that is a token but no part of a
  longer one, as are most of a script without spaces.

A text is cut in chunks.  The state map of a chunk is (head, body, exit): the characters before
its first known state, the tokens after it, and the state at its end.  Maps compose
associatively; those of neighbours are combined in rounds, each half as many as the one before, and the
last one of a text is applied to the start state.
"""

from __future__ import annotations

import functools
import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.texts import record_batch, rows, written

MARK = "▁"
CHUNK_CHARS = 32_768
#: Bounds of what a worker keeps; beyond them it forgets and compiles again, with the same counts.
REMEMBERED_WORDS = 200_000
KNOWN_STATES = 200_000
KNOWN_PAIRS = 200_000

_RUN = re.compile(" +[^ ]*")
_EDGE = re.compile("(?<=[^ ]) ")

# a state: ((typed prefix, last token before it or "", tokens before it minus tokens now), ...)
State = tuple[tuple[str, str, int], ...]
START: State = (("", "", 0),)


def sentencepiece_vocabulary(path: str) -> dict[str, float]:
    """Ordinary pieces and their scores; byte, control and unknown pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    }


class Transducer:
    """Deterministic token counter of one vocabulary; states are compiled when first met."""

    def __init__(self, vocabulary: dict[str, float]):
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in vocabulary):
            raise ValueError("a token spans a word mark; the vocabulary has no known state between words")
        self.scores = vocabulary
        self.letters = {piece for piece in vocabulary if len(piece) == 1}
        self.open = {piece[:i] for piece in vocabulary for i in range(1, len(piece))}
        self.alone = self.letters - {char for piece in vocabulary if len(piece) > 1 for char in piece}
        self.pairs: dict[tuple[str, str], bool] = {}
        self._forget()
        self.words = _Remembered(self)

    def _forget(self) -> None:
        self.numbers: dict[State, int] = {}
        self.states: list[State] = []
        self.steps: list[dict[str, tuple[int, int]]] = []
        self.number(START)

    def number(self, state: State) -> int:
        found = self.numbers.get(state)
        if found is None:
            found = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return found

    def _merged(self, text: str) -> list[str]:
        """BPE of a short string by its definition: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stable(self, before: str, token: str) -> bool:
        found = self.pairs.get((before, token))
        if found is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            expected = [before, token] if before else [token]
            found = self.pairs[before, token] = self._merged(before + token) == expected
        return found

    def _compile(self, state: State, char: str) -> tuple[int, int]:
        """The transition of a character that is a token itself: (next state, change of the count)."""
        grown = [(sys.intern(prefix + char), last, rel) for prefix, last, rel in state]
        token, change = next(
            (prefix, rel + 1)
            for prefix, last, rel in grown
            if prefix in self.scores and self.stable("", prefix) and (not last or self.stable(last, prefix))
        )
        following = [(prefix, last, rel - change) for prefix, last, rel in grown if prefix in self.open]
        return self.number((*following, ("", token, 0))), change

    def run(self, state: State, text: str) -> tuple[State, int]:
        """Follow ``text`` from ``state``: the state it ends in and the tokens it adds."""
        if len(self.states) > KNOWN_STATES:
            self._forget()
        at, total, steps = self.number(state), 0, self.steps
        for char in text.replace(" ", MARK):
            step = steps[at].get(char)
            if step is None:
                if char in self.letters:
                    step = self._compile(self.states[at], char)
                else:  # one token a byte, and nothing reaches across
                    step = (self.number(START), len(char.encode()))
                steps[at][char] = step
            at, change = step
            total += change
        return self.states[at], total

    def count(self, marked: str) -> int:
        """Tokens of a text that begins with a space (the word mark) and starts in a known state."""
        parts = marked[1:].split(" ")
        if "" in parts:  # runs of spaces belong to the word after them
            parts = [run[1:] for run in _RUN.findall(marked)]
        return sum(map(self.words.__getitem__, parts))

    def settled(self, text: str) -> tuple[int, State] | None:
        """The first place of a text without word marks where the state is known, whatever it was before, and the state."""
        for at, char in enumerate(text, 1):
            if char in self.alone:
                return at, (("", char, 0),)
            if char not in self.letters and char != " ":
                return at, START
        return None

    def chunk_map(self, chunk: str) -> tuple[str, int, State | None]:
        """(head, body, exit) of a chunk; exit is None if no known state was met."""
        edge = _EDGE.search(chunk)
        first = len(chunk) if edge is None else edge.start()
        known = self.settled(chunk[:first])
        head, state, body = chunk[:first], None, 0
        if known is not None:
            head = chunk[: known[0]]
            state, body = self.run(known[1], chunk[known[0] : first])
        if edge is None:
            return head, body, state
        last = max(chunk.rfind(" ", 0, len(chunk)), first)
        while last > first and chunk[last - 1] == " ":
            last -= 1
        body += self.count(chunk[first:last]) if last > first else 0
        state, rest = self.run(START, chunk[last:])
        return head, body + rest, state

    def compose(self, a: tuple[str, int, State | None], b: tuple[str, int, State | None]):
        """The map of two neighbouring chunks."""
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        state, bridge = self.run(a[2], b[0])
        return a[0], a[1] + bridge + b[1], state if b[2] is None else b[2]

    def apply(self, whole: tuple[str, int, State | None]) -> int:
        return self.run(START, whole[0])[1] + whole[1]


class _Remembered(dict):
    """Tokens of a word (without its mark) between two known states, counted when first met."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        tokens = self.transducer.run(START, f" {word}")[1]
        if len(word) <= 64:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = tokens
        return tokens


@functools.cache
def compiled(path: str) -> Transducer:
    """One transducer a Python worker."""
    return Transducer(sentencepiece_vocabulary(path))


_SHORT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
_MAPS = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("text_hash", pa.int64()), ("chunk", pa.int32())]
    + [("head", pa.string()), ("body", pa.int64()), ("exit", pa.string())]
)


def _whole(path: str):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(path)
        for batch in batches:
            found = []
            for doc, size, text in rows(batch, "doc_id", "n_bytes", "text"):
                text = text.replace(MARK, " ")
                found.append((doc, size, transducer.count(f" {text}") if text else 0))
            yield record_batch(_SHORT, found)

    return counted


def _mapped(path: str):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(path)
        for batch in batches:
            found = []
            for doc, size, key, number, text in rows(batch, "doc_id", "n_bytes", "text_hash", "chunk", "part"):
                mark = "" if number else " "  # a text begins with a word mark
                head, body, state = transducer.chunk_map(mark + text.replace(MARK, " "))
                found.append((doc, size, key, number, head, body, None if state is None else json.dumps(state)))
            yield record_batch(_MAPS, found)

    return mapped


_MAP_DDL = "doc_id long, n_bytes long, text_hash long, chunk int, copies long, head string, body long, exit string"
_JOINED = pa.schema([*list(_MAPS)[:4], ("copies", pa.int64()), *list(_MAPS)[4:]])


def _joined(path: str):
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(path)
        for batch in batches:
            found = []
            for *key, maps in rows(batch, "doc_id", "n_bytes", "text_hash", "chunk", "copies", "maps"):
                head, body, state = functools.reduce(transducer.compose, map(_read_map, maps))
                found.append((*key, head, body, None if state is None else json.dumps(state)))
            yield record_batch(_JOINED, found)

    return joined


def _read_map(m: dict) -> tuple[str, int, State | None]:
    return m["head"], m["body"], None if m["exit"] is None else tuple(map(tuple, json.loads(m["exit"])))


def _applied(path: str):
    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(path)
        for batch in batches:
            found = []
            for doc, size, copies, head, body in rows(batch, "doc_id", "n_bytes", "copies", "head", "body"):
                found += [(doc, size, transducer.apply((head, body, None)))] * copies
            yield record_batch(_SHORT, found)

    return applied


def token_counts(docs: DataFrame, model: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; ``model`` is a sentencepiece BPE model file.

    Texts of up to ``chunk_chars`` characters are counted where they are read.  Longer ones are
    cut, their chunks dealt over all tasks, and only the chunks' state maps are brought together, two
    neighbours at a time in as many rounds as the longest text needs.  A map is the characters up to the first
    known state; of a text without any (letters without a space or a line end, as in base64) it is the text.

    Null and empty texts have no bytes and no tokens.  Repeated rows stay repeated, also under one
    doc_id; a null doc_id is kept.  An empty table gives no rows.  Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    long = F.length("text") > chunk_chars
    counted = "doc_id long, n_bytes long, n_tokens long"
    short = base.filter(~long).mapInArrow(_whole(model), counted)

    last = F.floor((F.length("text") - 1) / chunk_chars).cast("int")
    chunks = (
        base.filter(long)
        .select("doc_id", "n_bytes", "text", F.xxhash64("text").alias("text_hash"), F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
        .select("doc_id", "n_bytes", "text_hash", "chunk", F.expr(f"substring(text, chunk * {chunk_chars} + 1, {chunk_chars})").alias("part"))
        .repartition("doc_id", "text_hash", "chunk")
    )
    schema = "doc_id long, n_bytes long, text_hash long, chunk int, head string, body long, exit string"
    maps = chunks.mapInArrow(_mapped(model), schema)
    # identical rows: one map a chunk and a count
    once = maps.groupBy("doc_id", "n_bytes", "text_hash", "chunk").agg(
        F.count("*").alias("copies"), *[F.first(name).alias(name) for name in ("head", "body", "exit")]
    )
    once = written(once, "token-maps")
    most = once.agg(F.max("chunk").alias("chunk")).first().chunk or 0
    for _ in range(most.bit_length()):
        half = F.floor(F.col("chunk") / 2).cast("int").alias("chunk")
        pairs = once.groupBy("doc_id", "n_bytes", "text_hash", half).agg(
            F.max("copies").alias("copies"),
            F.sort_array(F.collect_list(F.struct("chunk", "head", "body", "exit"))).alias("maps"),
        )
        once = pairs.mapInArrow(_joined(model), _MAP_DDL)
    return short.unionByName(once.mapInArrow(_applied(model), counted))
