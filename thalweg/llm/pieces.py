"""SentencePiece encoding and decoding: a max-plus parallel scan over chunks that gives the ids of a BPE model file.

The ids are those of the library. A sequence of pieces is a text's BPE encoding exactly if each two that follow each other are the encoding of
the two joined; so the encoding is the one path through the lattice of pieces on which all neighbours agree, and its score, the sum of
the pieces' scores, is the best of a lattice without other paths. A chunk of a giant text maps boundary states to boundary states: state
(a, k) means that the piece across the boundary begins a characters before it and ends k behind it. The scores of the paths between states
form a matrix; matrices combine associatively by max and plus, group by group in a tree over tasks. The tree then hands every chunk
the scores that lead to its entry states from the text's start and from its exit states to the text's end. With both, every chunk finds its
own pieces by itself.

Texts fall apart at places that no piece of the vocabulary crosses; between two such places pieces come from the library and are
remembered by segment. Only what touches a boundary goes through the lattice.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.bytesops import text_batches
from thalweg.session import stage_table

SPACE = "▁"
#: Characters in a chunk; texts up to this size are one chunk.
CHUNK = 1 << 15
#: Matrices that one step of the tree combines.
FAN = 64
#: A character that the vocabulary lacks scores as a piece behind all others.
UNKNOWN = -(1 << 24)
#: Segments in either half of a worker's memory, some 200 bytes each; longer ones than so many characters are not remembered.
REMEMBERED, LONGEST_REMEMBERED = 300_000, 64

#: A boundary state, and the one at either end of a text.
State = tuple[int, int]
EDGE: State = (0, 0)
Matrix = dict[tuple[State, State], int]


class PieceModel:
    """The pieces and scores of a BPE model file, and the library that reads it."""

    _known: dict[str, PieceModel] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        normal = [i for i in range(len(self.pieces)) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.score = {self.pieces[i]: round(sp.get_score(i)) for i in normal}
        self.id_of = {self.pieces[i]: i for i in normal}
        self.scores = np.array([self.score.get(p, 0) for p in self.pieces], np.int64)
        self.byte_value = {i: int(self.pieces[i][3:5], 16) for i in range(len(self.pieces)) if sp.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_value.items()}
        self.unk = sp.unk_id()
        self.longest = max(map(len, self.score), default=1)
        self.cut = self._cuts([p for p in self.score if len(p) > 1])
        #: What the library puts before a text's own ids when it begins with a line end, which no piece holds together with others.
        self.lead = len(sp.encode("\n"))
        #: Segments met lately, and those met before them.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        #: What an id adds to a text by itself; bytes beyond ASCII only do so in runs.
        self.shown = [chr(self.byte_value[i]) if self.byte_value.get(i, 128) < 128 else p.replace(SPACE, " ") for i, p in enumerate(self.pieces)]
        self.in_run = np.zeros(len(self.pieces), bool)
        self.in_run[[i for i, b in self.byte_value.items() if b >= 128]] = True

    @staticmethod
    def _cuts(inner: list[str]) -> re.Pattern:
        """A pattern for the segments of a text that no piece of several characters crosses, as the vocabulary allows.

        Texts fall apart before spaces, around line ends, and between letters or digits and other marks. Letters that share a
        piece with marks count as marks. A vocabulary with pieces across spaces or line ends can't be cut.
        """
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in inner):
            raise ValueError("a vocabulary with pieces across spaces or line ends")
        pairs = {(a, b) for p in inner for a, b in zip(p, p[1:], strict=False) if SPACE not in (a, b)}
        marks = {"_"}
        while True:
            letter = lambda c: c.isalnum() and c not in marks  # noqa: E731,B023
            more = {a if letter(a) else b for a, b in pairs if letter(a) != letter(b)}
            if not more:
                break
            marks |= more
        extra = "".join(map(re.escape, sorted(marks)))
        return re.compile(rf"{SPACE}*(?:[^\W{extra}]+|(?:[^\w{SPACE}\n]|[{extra}])+)|{SPACE}+|\n")

    @classmethod
    def at(cls, path: str) -> PieceModel:
        if path not in cls._known:
            cls._known[path] = cls(path)
        return cls._known[path]

    # ---- segments

    def learn(self, segments: set[str]) -> dict[str, bytes]:
        """Ids of segments by the library, which puts a space in front of each text: those that aren't just that and more go behind a line end."""
        own = sorted(segments)
        bare = [s[0] != SPACE or not s.strip(SPACE) for s in own]
        found = self.sp.encode([("\n" + s if b else s[1:]).replace(SPACE, " ") for s, b in zip(own, bare, strict=True)], num_threads=1)
        return {s: np.array(ids[self.lead :] if b else ids, np.uint32).tobytes() for s, b, ids in zip(own, bare, found, strict=True)}

    def segments(self, texts: list[str]) -> list[bytes]:
        """Ids of normalised texts that begin and end at places that no piece crosses."""
        lists = [self.cut.findall(t) for t in texts]
        met = {s for own in lists for s in own}
        here = {}
        new = set()
        for s in met:
            ids = self.words.get(s) or self.older.get(s)
            if ids is None:
                new.add(s)
            else:
                here[s] = ids
        here |= self.learn(new) if new else {}
        if len(self.words) + len(here) > REMEMBERED:
            self.older, self.words = self.words, {}
        self.words.update((s, ids) for s, ids in here.items() if len(s) <= LONGEST_REMEMBERED)
        return [b"".join(map(here.__getitem__, own)) for own in lists]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        full = [k for k, t in enumerate(texts) if t]
        out = [np.empty(0, np.uint32)] * len(texts)
        for k, ids in zip(full, self.segments([normalise(texts[k]) for k in full]), strict=True):
            out[k] = np.frombuffer(ids, np.uint32)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids with the space that is put in front: pieces in a row, runs of byte pieces as UTF-8, spaces for their marks."""
        if not self.in_run[ids].any():
            return "".join(map(self.shown.__getitem__, ids.tolist()))
        out, run = [], bytearray()
        for i in ids.tolist():
            b = self.byte_value.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.shown[i])
        out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    # ---- the lattice

    def merged(self, text: str) -> list[str]:
        """The BPE encoding of a short string, as strings: the best-scored neighbours are joined, leftmost first, until none can be."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, 0
            for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)):
                score = self.score.get(a + b)
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands(self, piece: str) -> bool:
        """Whether a string is a piece of its own encoding: a piece that merging reaches, or any single character."""
        found = self.whole.get(piece)
        if found is None:
            found = self.whole[piece] = len(piece) == 1 or piece in self.score and self.merged(piece) == [piece]
        return found

    def agree(self, a: str, b: str) -> bool:
        """Whether two pieces stay apart when they follow each other."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return found

    def ids(self, piece: str) -> list[int]:
        found = self.id_of.get(piece)
        if found is not None:
            return [found]
        data = piece.encode()
        return [self.byte_id[b] for b in data] if all(b in self.byte_id for b in data) else [self.unk]

    def boundary(self, text: str, at: int) -> list[State]:
        """The states that a boundary may have: pieces that hold the character before it."""
        return [(a, k) for a in range(1, min(self.longest, at) + 1) for k in range(min(self.longest - a, len(text) - at) + 1) if self.stands(text[at - a : at + k])]

    def walk(self, text: str, first: tuple[int, int], stop: int) -> dict[tuple[int, int], tuple[int, tuple[int, int] | None]]:
        """All pieces (start, end) that agree in a row behind the piece ``first``, each with its path's score and the piece before it.

        Pieces start before ``stop``; an empty ``first`` stands for a place that no piece crosses.
        """
        found: dict[tuple[int, int], tuple[int, tuple[int, int] | None]] = {first: (0, None)}
        ends: dict[int, list[tuple[int, int]]] = {first[1]: [first]}
        for j in range(first[1], stop):
            for before in ends.get(j, ()):
                last, score = text[before[0] : j], found[before][0]
                for end in range(j + 1, min(j + self.longest, len(text)) + 1):
                    piece = text[j:end]
                    if self.stands(piece) and (not last or self.agree(last, piece)):
                        total = score + self.score.get(piece, UNKNOWN)
                        if (j, end) not in found:
                            ends.setdefault(end, []).append((j, end))
                            found[j, end] = total, before
                        elif total > found[j, end][0]:
                            found[j, end] = total, before
        return found

    def chunk(self, text: str, begin: int, end: int, is_last: bool) -> Chunk:
        return Chunk(self, text, begin, end, is_last)


class Chunk:
    """A chunk [begin, end) of a normalised text, with what lies ``longest`` characters around it."""

    def __init__(self, model: PieceModel, text: str, begin: int, end: int, is_last: bool):
        self.model, self.text, self.begin, self.end = model, text, begin, end
        self.entries: list[State] = model.boundary(text, begin) if begin else [EDGE]
        self.exits: list[State] = [EDGE] if is_last else model.boundary(text, end)
        # the first and the last place in the chunk that no piece crosses, seen with the characters around it
        places = [m.start() for m in model.cut.finditer(text) if begin < m.start() < end] if begin else [m.start() for m in model.cut.finditer(text) if m.start() < end]
        # a match that starts with the text itself may be the rest of a longer one
        self.places = (places[0], places[-1]) if places else None
        self.is_last = is_last
        self._middle: np.ndarray | None = None

    def _entered(self, state: State) -> tuple[int, int]:
        return self.begin - state[0], self.begin + state[1]

    def _left(self, found: dict, state: State) -> tuple[int, tuple[int, int]] | None:
        """Score and last piece of the path to an exit state."""
        if self.is_last:
            ends = [(score, p) for p, (score, _) in found.items() if p[1] == self.end]
            return max(ends) if ends else None
        piece = self.end - state[0], self.end + state[1]
        return (found[piece][0], piece) if piece in found else None

    def matrix(self) -> Matrix:
        """Scores of the pieces that start in the chunk, by entry and exit state; pairs without a path are left out."""
        out: Matrix = {}
        if self.places is None:
            for e in self.entries:
                found = self.model.walk(self.text, self._entered(e), self.end)
                for f in self.exits:
                    if (left := self._left(found, f)) is not None:
                        out[e, f] = left[0]
            return out
        first, last = self.places
        found = self.model.walk(self.text, (last, last), self.end)
        tails = {f: left[0] for f in self.exits if (left := self._left(found, f)) is not None}
        middle = int(self.model.scores[self.middle()].sum())
        for e in self.entries:
            head = self._head(e, first)
            if head is not None:
                for f, tail in tails.items():
                    out[e, f] = head[0] + middle + tail
        return out

    def middle(self) -> np.ndarray:
        """The ids between the first and the last place that no piece crosses."""
        if self._middle is None:
            first, last = self.places
            self._middle = np.frombuffer(self.model.segments([self.text[first:last]])[0], np.uint32)
        return self._middle

    def _head(self, state: State, first: int) -> tuple[int, list[tuple[int, int]]] | None:
        """Score and pieces of the path from an entry state to the first place that no piece crosses."""
        begin = self._entered(state)
        if begin[1] > first:
            return None
        found = self.model.walk(self.text, begin, first)
        ends = [p for p in found if p[1] == first]
        if not ends:
            return None
        best = max(ends, key=lambda p: found[p][0])
        return found[best][0], self._back(found, best)

    @staticmethod
    def _back(found: dict, piece: tuple[int, int]) -> list[tuple[int, int]]:
        out = []
        while found[piece][1] is not None:
            out.append(piece)
            piece = found[piece][1]
        return out[::-1]

    def path(self, before: dict[State, int], behind: dict[State, int]) -> tuple[list[int], int, int]:
        """The chunk's own ids, given the scores that lead to its entries and from its exits, and the text [begin, end) that they stand for."""
        matrix = self.matrix()
        e, f = max((p for p in matrix if p[0] in before and p[1] in behind), key=lambda p: before[p[0]] + matrix[p] + behind[p[1]])
        ids: list[int] = []
        start, stop = self._entered(e)[1], self.end if self.is_last else self.end + f[1]

        def add(pieces: list[tuple[int, int]]) -> None:
            for a, b in pieces:
                ids.extend(self.model.ids(self.text[a:b]))

        if self.places is None:
            found = self.model.walk(self.text, self._entered(e), self.end)
            add(self._back(found, self._left(found, f)[1]))
            return ids, start, stop
        first, last = self.places
        add(self._head(e, first)[1])
        ids += self.middle().tolist()
        found = self.model.walk(self.text, (last, last), self.end)
        add(self._back(found, self._left(found, f)[1]))
        return ids, start, stop


def normalise(text: str) -> str:
    """A space in front, and marks for spaces."""
    return SPACE + text.replace(" ", SPACE)


def combine(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product of two matrices."""
    rows: dict[State, list[tuple[State, int]]] = {}
    for (e, f), score in b.items():
        rows.setdefault(e, []).append((f, score))
    out: Matrix = {}
    for (e, m), score in a.items():
        for f, more in rows.get(m, ()):
            if (e, f) not in out or score + more > out[e, f]:
                out[e, f] = score + more
    return out


def lead(before: dict[State, int], m: Matrix) -> dict[State, int]:
    """The scores that lead to a matrix's exits."""
    out: dict[State, int] = {}
    for (e, f), score in m.items():
        if e in before:
            out[f] = max(out.get(f, before[e] + score), before[e] + score)
    return out


def trail(m: Matrix, behind: dict[State, int]) -> dict[State, int]:
    """The scores from a matrix's entries."""
    return lead(behind, {(f, e): score for (e, f), score in m.items()})


def spread(matrices: list[Matrix], before: dict[State, int], behind: dict[State, int]) -> list[tuple[dict[State, int], dict[State, int]]]:
    """For each of some matrices in a row, the scores to its entries and from its exits, given those of the row."""
    to, back = [before], [behind]
    for m in matrices[:-1]:
        to.append(lead(to[-1], m))
    for m in reversed(matrices[1:]):
        back.append(trail(m, back[-1]))
    return list(zip(to, reversed(back), strict=True))


def _pack(entries: list[tuple[State, State, int]]) -> bytes:
    return np.array([(*e, *f, s) for e, f, s in entries], np.int64).tobytes()


def _unpack(data: bytes) -> list[tuple[State, State, int]]:
    return [((a, b), (c, d), s) for a, b, c, d, s in np.frombuffer(data, np.int64).reshape(-1, 5).tolist()]


def _matrix(data: bytes) -> Matrix:
    return {(e, f): s for e, f, s in _unpack(data)}


def _vector(data: bytes) -> dict[State, int]:
    return {e: s for e, _, s in _unpack(data)}


def matrix_bytes(m: Matrix) -> bytes:
    return _pack([(e, f, s) for (e, f), s in m.items()])


def _vector_bytes(v: dict[State, int]) -> bytes:
    return _pack([(e, EDGE, s) for e, s in v.items()])


def chunks_of(text: str, size: int, view: int) -> list[tuple[str, int, int, bool]]:
    """A normalised text in chunks of ``size`` characters: text with ``view`` more on both sides, own begin and end in it, and whether it is the last."""
    out = []
    for at in range(0, len(text), size):
        low, stop = max(0, at - view), min(at + size, len(text))
        out.append((text[low : stop + view], at - low, stop - low, stop == len(text)))
    return out


def encode_chunked(model: PieceModel, text: str, size: int) -> list[int]:
    """The ids of a text by the scan, in one process."""
    if not text:
        return []
    chunks = [model.chunk(*c) for c in chunks_of(normalise(text), size, model.longest)]
    around = spread([c.matrix() for c in chunks], {EDGE: 0}, {EDGE: 0})
    return [i for c, (to, back) in zip(chunks, around, strict=True) for i in c.path(to, back)[0]]


# ---- over tables

_OUT = "doc_id long, chunk int, n_chunks int, n_tokens long, ids_crc32 long, round_trip boolean, ids array<int>"


def _frame(rows: list[tuple]) -> pa.RecordBatch:
    """A batch from rows of doc_id, chunk, n_chunks, whether they decode again, and ids."""
    ids = [r[4] for r in rows]
    lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, ids)]).astype(np.int32), pa.array(np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.int32)))
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))]
    crc = pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())
    return pa.RecordBatch.from_arrays([*columns, pa.array(list(map(len, ids)), pa.int64()), crc, pa.array([r[3] for r in rows], pa.bool_()), lists], names=[x.split()[0] for x in _OUT.split(", ")])


def encode_texts(docs: DataFrame, model_path: str, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, chunk, n_chunks, n_tokens, ids_crc32, round_trip, ids) of ``docs`` (doc_id, text, any more columns): a row for each chunk of a text.

    Texts of up to ``chunk`` characters are one chunk and encoded where they are; longer ones are dealt out by chunk, and the ids of their chunks in a
    row are the text's. ``round_trip`` says whether a chunk's ids decode to the text that they stand for. A null or empty text has a row without
    ids; rows that repeat come back each; an empty table gives no rows.
    """
    text_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.at(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for k in range(0, len(texts), 256):
                part = texts[k : k + 256]
                # a mark of a space in the text itself decodes as a space
                yield _frame([(d, 0, 1, model.decode(x)[1:] == t.replace(SPACE, " "), x) for d, t, x in zip(batch.column(0).slice(k, 256).to_pylist(), part, model.encode(part), strict=True)])

    short = base.filter(F.length("text") <= chunk).mapInArrow(small, _OUT)

    view = PieceModel.at(model_path).longest
    if chunk < view:
        raise ValueError(f"chunks must have {view} characters at least")
    giant = base.filter(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    giant = giant.withColumn("text", F.concat(F.lit(SPACE), F.replace("text", F.lit(" "), F.lit(SPACE)))).withColumn("n", F.length("text"))
    parts = giant.select("row", "doc_id", "text", "n", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {chunk}").cast("int"))).alias("i"))
    at = F.col("i") * chunk
    low = F.greatest(at - view, F.lit(0))
    parts = parts.select(
        "row", "doc_id", "i", F.expr(f"(n - 1) div {chunk} + 1").cast("int").alias("n_chunks"), F.substring("text", low + 1, F.lit(chunk + 2 * view) - (low - at + view)).alias("part"),
        (at - low).alias("begin"), (F.least(at + chunk, F.col("n")) - low).cast("int").alias("end"),
    )
    parts = stage_table(parts, "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.at(model_path)
        for batch in batches:
            found = [matrix_bytes(model.chunk(r["part"], r["begin"], r["end"], r["i"] == r["n_chunks"] - 1).matrix()) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["row", "i", "m"])

    def up(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        product = None
        for m in frame.sort_values("i")["m"]:
            product = _matrix(m) if product is None else combine(product, _matrix(m))
        return pd.DataFrame({"row": [key[0]], "i": [key[1]], "m": [matrix_bytes(product)]})

    def down(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("i")
        around = spread([_matrix(m) for m in frame["m"]], _vector(frame["to"].iloc[0]), _vector(frame["back"].iloc[0]))
        return pd.DataFrame({"row": frame["row"], "i": frame["i"], "to": [_vector_bytes(a) for a, _ in around], "back": [_vector_bytes(b) for _, b in around]})

    # up the tree: products of FAN matrices in a row, until each text has one; down again: every matrix learns what stands around it
    levels = [stage_table(parts.select("row", "i", "part", "begin", "end", "n_chunks").mapInArrow(matrices, "row long, i int, m binary"), "matrices")]
    most = parts.agg(F.max("n_chunks")).first()[0] or 0
    group = F.expr(f"i div {FAN}").cast("int")
    while most > 1:
        most = -(-most // FAN)
        levels.append(stage_table(levels[-1].groupBy("row", group.alias("g")).applyInPandas(up, "row long, i int, m binary"), "matrices"))
    end = F.lit(_vector_bytes({EDGE: 0}))
    around = levels.pop().select("row", "i", end.alias("to"), end.alias("back"))
    for level in reversed(levels):
        rows = level.withColumn("g", group).join(around.withColumnRenamed("i", "g"), ["row", "g"])
        around = rows.groupBy("row", "g").applyInPandas(down, "row long, i int, to binary, back binary")

    def backtrace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.at(model_path)
        for batch in batches:
            for r in batch.to_pylist():
                own = model.chunk(r["part"], r["begin"], r["end"], r["i"] == r["n_chunks"] - 1)
                ids, start, stop = own.path(_vector(r["to"]), _vector(r["back"]))
                ids = np.array(ids, np.uint32)
                yield _frame([(r["doc_id"], r["i"], r["n_chunks"], model.decode(ids) == r["part"][start:stop].replace(SPACE, " "), ids)])

    traced = parts.join(around, ["row", "i"]).select("doc_id", "i", "n_chunks", "part", "begin", "end", "to", "back")
    return short.union(traced.mapInArrow(backtrace, _OUT))


def decode_texts(chunks: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, chunk, n_chunks, text) of rows with ``ids``; the texts of a document's chunks in a row are its text. Null or no ids give an empty text."""

    @F.arrow_udf("string")
    def text(ids: pa.Array, chunk: pa.Array) -> pa.Array:
        model = PieceModel.at(model_path)
        # the space in front belongs to the first chunk
        return pa.array([model.decode(np.array(x or [], np.int64))[1 if c == 0 else 0 :] for x, c in zip(ids.to_pylist(), chunk.to_pylist(), strict=True)], pa.string())

    return chunks.select("doc_id", "chunk", "n_chunks", text("ids", "chunk").alias("text"))
