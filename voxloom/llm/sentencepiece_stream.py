"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice has a node for each position between characters and an edge for each
vocabulary piece.  Edge (a, b) may follow another only if the vocabulary's merges
turn the text of both into exactly the pieces a and b; all other steps weigh minus
infinity.  One path then survives at each node, and it is the encoding that greedy
merging by rank gives, because a merge that crosses a boundary would already show
in the pair around it.  So the ids equal those of the SentencePiece library for its
BPE models, while the search reads the text once from left to right.

Pieces have a longest length L, hence only nodes among the last L can be extended, and of
these only the ones from which the text read so far is the beginning of some piece.  These
live nodes are the window.  Whenever the backpointer paths of all of them pass one
boundary, the ids before it are committed and what lies before it is dropped; in ordinary
text that is at each space and each character that occurs in no longer piece.  Where paths
do not meet (long runs of one character) the undecided steps stay, as one id each.

Texts are fed whole to that search, a word with the space after it at a time.  The state
between two steps (live nodes, their undecided paths, the piece before the boundary) is
interned, and the search remembers which ids a word commits from a state and which state
it leads to, in two generations of bounded size.  A remembered step gives what the search
would give, so texts run through the same states either way.

Cases: null and empty texts have no ids and decode to the empty text.  Characters
outside the vocabulary become byte pieces, or the unknown id where there are none.
A literal U+2581 decodes as a space, as in the library.  Very long texts and words
stream through the window.  Rows are encoded one by one, so ties, repeated rows and
empty tables need no rule.  Only named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .worker import keep

SPACE = "▁"
#: A noncharacter, which stands before the first character and is in no piece.
OUTSIDE = "\uffff"
#: Steps remembered by a worker in each of two generations, and the longest such step.
MEMO, LONGEST_STEP = 250_000, 64
#: Pairs of pieces whose merging is remembered.
COMPARED = 400_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces in order of their ids; rank decides which merge comes first."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    normal: tuple[int, ...]  # ids of pieces that text can become
    byte_ids: tuple[int, ...]  # id of each byte value, or empty
    unknown: int
    dummy_prefix: bool = True

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a BPE model file; other kinds and unusual normalisers are refused."""
        import sentencepiece.sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("a BPE model with identity normalisation is needed")
        if any(p.type == 4 for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        return Vocabulary(
            tuple(p.piece for p in model.pieces), tuple(p.score for p in model.pieces),
            tuple(i for i, p in enumerate(model.pieces) if p.type == 1),
            tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else (),
            next(i for i, p in enumerate(model.pieces) if p.type == 2), spec.add_dummy_prefix,
        )

    @property
    def key(self) -> str:
        return hashlib.md5(repr((self.pieces, self.scores)).encode()).hexdigest()


class State:
    """The search between two steps: the characters after the last boundary, for each node
    the piece that ends there (None for an unknown character) and where that starts, and
    the piece before the boundary.  ``young`` and ``old`` are the steps that are remembered."""

    __slots__ = ("text", "last", "start", "context", "rest", "young", "old")

    def __init__(self, text: str, last: list[str | None], start: list[int], context: str | None, rest: bytes):
        self.text, self.last, self.start, self.context = text, last, start, context
        self.rest = rest  # what a text that ends here still gives
        self.young: dict[str, tuple[bytes, State]] = {}
        self.old: dict[str, tuple[bytes, State]] = {}


class Lattice:
    """What a worker derives from a vocabulary once, and the search's states."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ids = {vocabulary.pieces[i]: i for i in vocabulary.normal}
        self.id_bytes = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.rank = {p: vocabulary.scores[i] for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        # Pieces by their characters from the last to the first: (children, the piece that starts
        # here, whether each piece may come before it).
        root: dict = {}
        for piece in self.ids:
            node = root
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = piece
        self.suffixes = self._compact(root)[0]
        # What a node's text must be for a piece to extend it.
        self.beginnings = {p[:n] for p in self.ids for n in range(1, len(p))}
        self.compared = 0
        longer = [p for p in self.ids if len(p) > 1]
        self.joined = {a + b for p in longer for a, b in zip(p, p[1:], strict=False)}
        self.joining = {pair[0] for pair in self.joined}
        inside = {c for p in longer for c in p}
        # No piece crosses these characters, so paths meet on both sides of them.
        lone = re.escape("".join(c for c in map(chr, range(1, 128)) if c not in inside and c != " "))
        ends = rf"(?: +|[{lone}])" if lone else "(?: +)"
        self.step = re.compile(rf"[^ {lone}]+{ends}?|{ends}")
        self.states: dict[tuple, State] = {}
        self.remembered = 0
        self.begin = self._state("", [None], [0], None)
        self.piece_bytes = [p.replace(SPACE, " ").encode() for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.byte_ids):
            self.piece_bytes[i] = bytes([b])
        controls = set(range(len(vocabulary.pieces))) - set(vocabulary.normal) - set(vocabulary.byte_ids)
        for i in controls:
            self.piece_bytes[i] = b""
        if not vocabulary.byte_ids:
            self.piece_bytes[vocabulary.unknown] = " ⁇ ".encode()

    def merged(self, text: str) -> list[str]:
        """Greedy merging by rank, leftmost first among equals; for texts of two pieces at most."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = self.rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r > best):
                    best, at = r, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compact(self, node: dict) -> tuple[dict, str | None, dict[str | None, bool]]:
        return {c: self._compact(x) for c, x in node.items() if c}, node.get(""), {}

    def may_follow(self, before: str | None, piece: str, known: dict[str | None, bool]) -> bool:
        """Whether merging leaves both pieces as they are; remembered with the piece."""
        self.compared += 1
        if self.compared > COMPARED:  # forget all, from the pieces that start the search
            self.compared, todo = 0, [*self.suffixes.values()]
            while todo:
                children, _, pairs = todo.pop()
                pairs.clear()
                todo += children.values()
        known[before] = good = self.merged((before or "") + piece) == ([before, piece] if before else [piece])
        return good

    def unknown_bytes(self, char: str) -> bytes:
        own = self.vocabulary.byte_ids
        ids = [own[b] for b in char.encode("utf-8", "replace")] if own else [self.vocabulary.unknown]
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _ids(self, text: str, last: list[str | None], start: list[int], end: int) -> bytes:
        """The ids of the path to a node."""
        path, ids, unknown = [], self.id_bytes, self.unknown_bytes
        while end:
            piece = last[end]
            path.append(unknown(text[end - 1]) if piece is None else ids[piece])
            end = start[end]
        path.reverse()
        return b"".join(path)

    def _state(self, text: str, last: list[str | None], start: list[int], context: str | None) -> State:
        key = (text, context, tuple(last), tuple(start))
        found = self.states.get(key)
        if found is None:
            found = State(text, last, start, context, self._ids(text, last, start, len(text)))
            if len(text) <= LONGEST_STEP:
                self.states[key] = found
        return found

    def _search(self, state: State, part: str) -> tuple[bytes, State]:
        """Extend the lattice by some characters; commit what the paths of all live nodes share."""
        text, context = state.text + part.replace(" ", SPACE), state.context
        last, start, suffixes, follow = list(state.last), list(state.start), self.suffixes, self.may_follow
        ends, starts, chars = last.append, start.append, OUTSIDE + text
        for end in range(len(state.text) + 1, len(text) + 1):
            j, children = end, suffixes
            while True:
                node = children.get(chars[j])
                if node is None:  # no piece: an unknown character
                    ends(None)
                    starts(end - 1)
                    break
                j -= 1
                children, piece, known = node
                if piece is not None:
                    before = last[j] if j else context
                    good = known.get(before)
                    if good is None:
                        good = follow(before, piece, known)
                    if good:
                        ends(piece)
                        starts(j)
                        break
        # The live nodes: the last, and those of the last L whose text since then begins a piece.
        n, p, live = len(text), len(text) - 1, {len(text)}
        while p >= 0 and n - p < self.longest and (p == n - 1 or text[p : p + 2] in self.joined):
            if text[p:] in self.beginnings:
                live.add(p)
            p -= 1
        while len(live) > 1:
            top = max(live)
            live.discard(top)
            live.add(start[top])
        end = live.pop()
        ids = self._ids(text, last, start, end)
        if end:
            context = last[end]
            text, last, start = text[end:], [None, *last[end + 1 :]], [0, *(s - end for s in start[end + 1 :])]
            # Live paths start at the boundary or after it; starts before it are of dead nodes.
            start = [max(0, s) for s in start]
        # What precedes the boundary matters only if some piece holds both characters around it.
        if context and (context[-1] not in self.joining or (text and context[-1] + text[0] not in self.joined)):
            context = None
        return ids, self._state(text, last, start, context)

    def advance(self, state: State, part: str) -> tuple[bytes, State]:
        """(ids committed, next state) when a part of the text arrives in a state."""
        if len(part) > LONGEST_STEP:
            ids = []
            for at in range(0, len(part), self.longest):
                some, state = self._search(state, part[at : at + self.longest])
                ids.append(some)
            return b"".join(ids), state
        hit = state.old.pop(part, None)
        if hit is None:
            hit = self._search(state, part)
        if self.remembered >= MEMO:
            self.states = {k: s for k, s in self.states.items() if s.young or s is self.begin}
            for s in self.states.values():
                s.old, s.young = s.young, {}
            self.remembered = 0
        state.young[part] = hit
        self.remembered += 1
        return hit

    def feed(self, state: State, text: str) -> tuple[bytes, State]:
        """(ids committed, next state) after more text, spaces as they are."""
        out, advance = [], self.advance
        for part in self.step.findall(text):
            hit = state.young.get(part)
            if hit is None:
                hit = advance(state, part)
            ids, state = hit
            out.append(ids)
        return b"".join(out), state

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian int32."""
        if not text:
            return b""
        # A literal U+2581 is the same as a space to the model.
        ids, state = self.feed(self.begin, (" " if self.vocabulary.dummy_prefix else "") + text.replace(SPACE, " "))
        return ids + state.rest

    def decode(self, ids: Iterable[int]) -> str:
        data = b"".join(map(self.piece_bytes.__getitem__, ids))
        if self.vocabulary.dummy_prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


class StreamingEncoder:
    """Feed text in parts of any size; ids come out once no later text can change them."""

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.state = lattice.begin
        self.pending = " " if lattice.vocabulary.dummy_prefix else ""

    @property
    def held(self) -> int:
        """Characters whose ids are not committed."""
        return len(self.state.text)

    def feed(self, text: str) -> list[int]:
        if not text:
            return []
        ids, self.state = self.lattice.feed(self.state, self.pending + text.replace(SPACE, " "))
        self.pending = ""
        return np.frombuffer(ids, "<i4").tolist()

    def finish(self) -> list[int]:
        rest, self.state = self.state.rest, self.lattice.begin
        return np.frombuffer(rest, "<i4").tolist()


def lattice_of(vocabulary: Vocabulary) -> Lattice:
    """One lattice, with its memory, for each vocabulary in a worker process."""
    return keep("sentencepiece", vocabulary.key, lambda: Lattice(vocabulary))


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """(id, ids, n_tokens, decoded, round_trip) of each text: ids as an array of int.

    With ``decode`` the ids are decoded again; ``decoded`` then holds the text only
    where it differs (texts with a literal U+2581), ``round_trip`` whether it is equal."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
         T.StructField("decoded", T.StringType()), T.StructField("round_trip", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = lattice_of(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = batch.column(1).to_pylist()
                coded = [lattice.encode(t) for t in texts]
                lengths = np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))
                flat = np.frombuffer(b"".join(coded), "<i4")
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                decoded, same = [None] * len(texts), [None] * len(texts)
                if decode:
                    ids = flat.tolist()
                    for k, t in enumerate(texts):
                        back = lattice.decode(ids[offsets[k] : offsets[k + 1]])
                        same[k] = back == t
                        decoded[k] = None if same[k] else back
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(lengths), pa.array(decoded, pa.string()), pa.array(same, pa.bool_())],
                    names=["id", "ids", "n_tokens", "decoded", "round_trip"],
                )

    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


def decode_documents(coded: DataFrame, vocabulary: Vocabulary, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows of ids; null ids give the empty text."""
    kind = coded.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = lattice_of(vocabulary)
        for batch in batches:
            texts = [lattice.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, T.StructType([T.StructField("id", kind), T.StructField("text", T.StringType())]))
