"""Token counts: the tokenizer compiled to a deterministic transducer, run over chunks.

The tokenizer is a score-ordered byte-pair model with byte fallback (a
``.model`` file). Its transducer reads code points and its transitions emit
token counts:

* A state holds, for each place a piece may still go on from, the trie node
  reached since, the token that ended there and the tokens emitted since. The
  last token of a prefix is the one piece that ends it and stands unmerged
  next to the token before it, so the next state and the change of the count
  are a function of state and code point. No place lies further back than the
  longest piece: the states are finite. They are built when first reached and
  kept up to a bound, then built again.
* Where no piece can go on (before a space, at a code point outside the
  vocabulary) all states meet in the start state. From there to the next such
  place the emitted count depends on the letters alone and is kept, too.
* A long text is cut into chunks. A chunk's state map is what it does to any
  entry state: the letters before its first meeting place, the count after
  it, the state it leaves. Maps compose, so a prefix scan over a text's chunks
  gives each chunk's token offset and the text's count.

Runs of spaces are counted apart: their pieces share one score, below all
others, so a run is merged after the words around it and only its length
matters.

No row is shuffled. Edge cases: null and empty texts have no bytes and no
tokens; repeated rows and a null doc_id are counted like any; other columns are
not read; an empty table gives an empty one; a text of any length is read whole,
a chunk at a time.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.session import ship_package

SPACE = "▁"  # fixed value: the model's sign for a space
CHUNK = 1 << 16  # code points
KEPT = 400_000  # transitions, and counts of letter runs, that a worker keeps


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The pieces of a short text: the best-scored adjacent pair first, the leftmost of equals."""
    parts = list(text)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class State:
    __slots__ = ("places", "run", "next")

    def __init__(self, places: tuple, run: int):
        self.places = places  # (trie node, token before, its count less the count here)
        self.run = run  # spaces just read
        self.next: dict[str, tuple[State, int]] = {}


class Transducer:
    """Deterministic, with token counts on its transitions; spaces are plain spaces here."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.letters = {p for p in scores if len(p) == 1}
        self.trie: list[dict[str, int]] = [{}]
        self.piece: list[str | None] = [None]
        longest_run = 1
        for p in scores:
            if p.strip(" "):
                if " " in p[1:]:
                    raise ValueError(f"a piece with a space inside it: {p!r}")
            else:
                longest_run = max(longest_run, len(p))
                if len(p) > 1:
                    continue
            at = 0
            for ch in p:
                if ch not in self.trie[at]:
                    self.trie[at][ch] = len(self.trie)
                    self.trie.append({})
                    self.piece.append(None)
                at = self.trie[at][ch]
            self.piece[at] = p
        runs = {scores[p] for p in scores if len(p) > 1 and not p.strip(" ")}
        words = [s for p, s in scores.items() if len(p) > 1 and p.strip(" ")]
        if runs and words and max(runs) >= min(words):
            raise ValueError("runs of spaces must merge last")
        # Tokens of a run of spaces: a table, and one token more per ``longest_run`` spaces beyond it.
        self.period = longest_run
        self.spaces = [len(merged(" " * k, scores)) for k in range(4 * longest_run + 1)]
        if any(self.spaces[k] != self.spaces[k - longest_run] + 1 for k in range(2 * longest_run, len(self.spaces))):
            raise ValueError("runs of spaces are not counted by their length")
        self.stands: dict[tuple[str | None, str], bool] = {}
        self.states: dict[tuple, State] = {}
        self.made = 0
        self.start = self.state(((0, None, 0),), 0)
        self.counts = Counts(self)
        cut = "" if "\n" in self.letters else "\n"
        self.cut = cut
        self.segments = re.compile(f" +[^ {cut}]*|\\n[^ {cut}]*" if cut else " +[^ ]*")
        self.meeting = re.compile(f"(?<=[^ ]) |{cut}" if cut else "(?<=[^ ]) ")

    def state(self, places: tuple, run: int) -> State:
        found = self.states.get((places, run))
        if found is None:
            found = self.states[(places, run)] = State(places, run)
        return found

    def unmerged(self, before: str | None, piece: str) -> bool:
        """Whether ``piece`` stands as a token next to the token ``before`` it."""
        key = (before, piece)
        if key not in self.stands:
            if len(self.stands) > KEPT:
                self.stands.clear()
            self.stands[key] = merged((before or "") + piece, self.scores) == ([before] if before else []) + [piece]
        return self.stands[key]

    def step(self, state: State, ch: str) -> tuple[State, int]:
        """The transition, built when first taken."""
        if self.made >= KEPT:
            for s in self.states.values():
                s.next.clear()
            self.states = {(s.places, s.run): s for s in (self.start, state)}
            self.made = 0
        done = self.transition(state, ch)
        state.next[ch] = done
        self.made += 1
        return done

    def transition(self, state: State, ch: str) -> tuple[State, int]:
        if ch == " ":
            run = state.run + 1
            more = self.spaces[run] - self.spaces[run - 1]
            if run > 3 * self.period:
                run -= self.period
            # The last space may yet begin a word: the count before it is needed, too.
            back = self.spaces[run - 1] - self.spaces[run]
            return self.state(((self.trie[0][" "], None, back), (0, " ", 0)), run), more
        if ch not in self.letters:
            return self.start, len(ch.encode("utf-8", "surrogatepass"))
        alive = [(self.trie[node][ch], before, count) for node, before, count in state.places if ch in self.trie[node]]
        if len(alive) == 1:  # no piece spans the last place: what came before does not matter
            alive = [(alive[0][0], None, 0)]
        for node, before, count in alive:
            piece = self.piece[node]
            if piece is not None and self.unmerged(before, piece):
                break
        else:
            raise ValueError(f"no token ends at {ch!r}")
        more = count + 1
        places = tuple((n, b, c - more) for n, b, c in alive if self.trie[n]) + ((0, piece, 0),)
        return self.state(places, 0), more

    def run(self, state: State, text: str) -> tuple[State, int]:
        total = 0
        for ch in text:
            step = state.next.get(ch)
            if step is None:
                step = self.step(state, ch)
            state = step[0]
            total += step[1]
        return state, total

    def chunk_map(self, text: str) -> "ChunkMap":
        met = self.meeting.search(text)
        if met is None:
            return ChunkMap(self, text, 0, None)
        parts = self.segments.findall(text, met.start())
        last = parts.pop()
        total = sum(map(self.counts.__getitem__, parts))
        state, more = self.run(self.start, last)
        return ChunkMap(self, text[:met.start()], total + more, state)


class Counts(dict):
    """Tokens of the letters from one meeting place to the next, kept for short ones."""

    def __init__(self, machine: Transducer):
        self.machine = machine

    def __missing__(self, letters: str) -> int:
        count = self.machine.run(self.machine.start, letters)[1]
        if len(letters) <= 32:
            if len(self) >= KEPT:
                self.clear()
            self[letters] = count
        return count


class ChunkMap:
    """What a chunk does to a state: run ``head``, then, past a meeting place, add ``count`` and leave ``exit``."""

    __slots__ = ("machine", "head", "count", "exit")

    def __init__(self, machine: Transducer, head: str, count: int, exit: State | None):
        self.machine, self.head, self.count, self.exit = machine, head, count, exit

    def apply(self, state: State) -> tuple[State, int]:
        after, count = self.machine.run(state, self.head) if self.head else (state, 0)
        return (after, count) if self.exit is None else (self.exit, count + self.count)

    def then(self, other: "ChunkMap") -> "ChunkMap":
        if self.exit is None:
            return ChunkMap(self.machine, self.head + other.head, other.count, other.exit)
        state, count = other.apply(self.exit)
        return ChunkMap(self.machine, self.head, self.count + count, state)


def prefix_scan(maps: list[ChunkMap], state: State) -> list[tuple[State, int]]:
    """(state, tokens) before each chunk and after the last, by a scan of pairwise compositions."""
    if not maps:
        return [(state, 0)]
    if len(maps) == 1:
        return [(state, 0), maps[0].apply(state)]
    pairs = [a.then(b) for a, b in zip(maps[::2], maps[1::2])] + ([maps[-1]] if len(maps) % 2 else [])
    at = prefix_scan(pairs, state)
    out = []
    for i, m in enumerate(maps):
        if i % 2 == 0:
            out.append(at[i // 2])
        else:
            before, done = at[i // 2]
            after, more = maps[i - 1].apply(before)
            out.append((after, done + more))
    return [*out, at[-1]]


def model_path(model: str) -> str:
    """A path as it is; the name of an installed public tokenizer file by its library."""
    if os.path.dirname(model):
        return model
    import public_tokenizers
    return public_tokenizers.path(model)


_COMPILED: dict[str, Transducer] = {}


def compiled(model: str) -> Transducer:
    """The model's transducer, once per worker."""
    if model not in _COMPILED:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path(model))
        probe = " AÅ  Ａ ﬁ\n"
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models that add a leading space and otherwise leave texts as they are")
        ids = range(sp.get_piece_size())
        if sum(sp.is_byte(i) for i in ids) != 256:
            raise ValueError("only models with byte fallback")
        _COMPILED[model] = Transducer({sp.id_to_piece(i).replace(SPACE, " "): sp.get_score(i) for i in ids
                                       if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))})
    return _COMPILED[model]


def offsets(machine: Transducer, text: str | None, chunk: int = CHUNK) -> list[int]:
    """The tokens before each chunk of ``text``, and its count at the end."""
    if not text:
        return [0]
    maps = []
    for at in range(0, len(text), chunk):
        part = text[at:at + chunk].replace(SPACE, " ")
        maps.append(machine.chunk_map(part if at else " " + part))
    return [count for _, count in prefix_scan(maps, machine.start)]


def count_tokens(docs: DataFrame, model: str = "piece_bpe_32k.model", chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``offsets`` (the tokens before each chunk of ``chunk`` code points) of every row."""
    ship_package(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        machine = compiled(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [offsets(machine, text.as_py(), chunk) for text in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([f[-1] for f in found], pa.int64()),
                     pa.array([f[:-1] for f in found], pa.list_(pa.int64()))],
                    ["doc_id", "n_bytes", "n_tokens", "offsets"])

    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, offsets array<long>")


def report(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096, **params) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row."""
    counted = count_tokens(docs, model, **params)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
