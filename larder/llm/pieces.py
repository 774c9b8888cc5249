"""SentencePiece encoding and decoding by suffix-array matching and relaxation of the resulting edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from sentencepiece import sentencepiece_model_pb2

from larder.llm.arrow import map_text, prepare, text_buffers, with_field
from larder.llm.ragged import gather, mix, span_hashes

SLICE_BYTES = 3 << 17  # text whose new segments are matched at once; their edges take some hundred times as much
CACHE_SYMBOLS = 1_000_000  # code points of distinct segments whose pieces a task remembers
PAIR_SLOTS = 1 << 20  # remembered answers about neighbouring pieces
SPACE = "▁"
_NEVER = np.int64(1 << 40)


class PieceModel:
    """A byte-pair SentencePiece model with identity normalisation, made ready for matching.

    Merge ranks follow the scores. For every piece it holds the chain of its rightmost and of its leftmost parts,
    each with the rank at which its own parent swallows it; they tell whether two neighbours can stand.
    """

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm = proto.normalizer_spec
        if (proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not proto.trainer_spec.byte_fallback):
            raise ValueError("a byte-pair model with byte fallback and identity normalisation is expected")
        texts = [p.piece for p in proto.pieces]
        normal = [k for k, p in enumerate(proto.pieces) if p.type == 1]
        self.byte_ids = np.array([texts.index(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.bytes = [p.piece.replace(SPACE, " ").encode() if p.type == 1 else bytes([int(p.piece[1:-1], 16)]) if p.type == 6
                      else b"" for p in proto.pieces]
        ids = {texts[k]: k for k in normal}
        rank_of = {texts[k]: r for r, k in enumerate(sorted(normal, key=lambda k: (-proto.pieces[k].score, k)))}
        parts = {}  # piece -> the two pieces of its last merge
        for text in ids:
            symbols = list(text)
            last = None
            while len(symbols) > 1:
                rank, at = min(((rank_of.get(a + b, len(rank_of)), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))))
                if rank == len(rank_of):
                    break
                last = symbols[at], symbols[at + 1]
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            if len(symbols) == 1 and (last is None or all(x in ids for x in last)):
                parts[text] = last
        self.names = [t for t in ids if t in parts]  # pieces that encoding can reach
        self.ids = np.array([ids[t] for t in self.names], np.int32)
        number = {t: k for k, t in enumerate(self.names)}
        self.lengths = np.array([len(t) for t in self.names])
        rank = {t: rank_of[t] if parts[t] else -1 for t in self.names}
        self.rank = np.array([rank[t] for t in self.names], np.int64)

        def chains(side: int) -> tuple[np.ndarray, np.ndarray]:
            rows, ends = [], []
            for text in self.names:
                chain, end, at, until = [], [], text, _NEVER
                while True:
                    chain.append(number[at])
                    end.append(until)
                    if parts[at] is None:
                        break
                    at, until = parts[at][side], rank[at]
                rows.append(chain)
                ends.append(end)
            depth = max(map(len, rows), default=1)
            return (np.array([r + [-1] * (depth - len(r)) for r in rows]), np.array([e + [-1] * (depth - len(e)) for e in ends]))

        self.right, self.right_end = chains(1)
        self.left, self.left_end = chains(0)
        keys = sorted((number[t[:k]] * len(number) + number[t[k:]], rank_of[t]) for t in ids for k in range(1, len(t))
                      if t[:k] in number and t[k:] in number)
        self.pair_keys, self.pair_ranks = np.array(keys, np.int64).reshape(-1, 2).T
        # symbols: code points of pieces, numbered from 1; bigrams inside pieces
        symbols = sorted({c for t in self.names for c in t})
        self.symbol = np.zeros(0x110000, np.uint16)
        self.symbol[[ord(c) for c in symbols]] = np.arange(1, len(symbols) + 1)
        self.inner = np.zeros((len(symbols) + 1,) * 2, bool)
        for t in self.names:
            s = self.symbol[[ord(c) for c in t]]
            self.inner[s[:-1], s[1:]] = True
        self.width = int(self.lengths.max())
        padded = np.zeros((2, len(self.names), self.width), ">u2")
        padded[1] = 0xFFFF
        for k, t in enumerate(self.names):
            padded[:, k, :len(t)] = self.symbol[[ord(c) for c in t]]
        self.first, self.last = (p.view(f"S{2 * self.width}").ravel() for p in padded)


class Encoder:
    """Encodes batches of texts; remembers the pieces of segments and which neighbours can stand."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.pair_slot = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_answer = np.zeros(PAIR_SLOTS, bool)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.begin, self.found, self.size = [0], [], 0

    def stands(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b can be neighbours: no merge across their border comes before the merges that
        make them. The parts that touch the border are followed on both sides; two of them that exist at one
        time and have a joint piece of a rank below that of their parents would have merged."""
        model, keys = self.model, a * len(self.model.names) + b
        slot = (mix(keys.astype(np.uint64)) & np.uint64(PAIR_SLOTS - 1)).astype(np.int64)
        unknown = np.flatnonzero(self.pair_slot[slot] != keys)
        answer = self.pair_answer[slot]
        if len(unknown):
            asked, inverse = np.unique(keys[unknown], return_inverse=True)
            x, y = asked // len(model.names), asked % len(model.names)
            fine = np.ones(len(asked), bool)
            for i in range(model.right.shape[1]):
                for j in range(model.left.shape[1]):
                    p, q = model.right[x, i], model.left[y, j]
                    end_p, end_q = model.right_end[x, i], model.left_end[y, j]
                    live = np.flatnonzero(fine & (p >= 0) & (q >= 0) & (model.rank[p] < end_q) & (model.rank[q] < end_p))
                    if not len(live):
                        continue
                    p, q = p[live], q[live]
                    pair = p * len(model.names) + q
                    at = np.minimum(np.searchsorted(model.pair_keys, pair), len(model.pair_keys) - 1)
                    when = np.maximum(model.pair_ranks[at], np.maximum(model.rank[p], model.rank[q]))
                    fine[live] &= ~((model.pair_keys[at] == pair) & (when < end_p[live]) & (when <= end_q[live]))
            answer[unknown] = fine[inverse]
            self.pair_slot[slot[unknown]], self.pair_answer[slot[unknown]] = keys[unknown], answer[unknown]
        return answer

    def match(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences (start, piece) in the text, by binary search of every piece in its suffix array.

        Suffixes are ordered by as many symbols as the longest piece has, which is all that a search compares.
        """
        model = self.model
        padded = np.concatenate((symbols, np.zeros(model.width, np.uint16))).astype(">u2")
        windows = np.lib.stride_tricks.sliding_window_view(padded, model.width)[:len(symbols)]
        suffixes = np.ascontiguousarray(windows).view(f"S{2 * model.width}").ravel()
        array = np.argsort(suffixes, kind="stable")
        suffixes = suffixes[array]
        low, high = np.searchsorted(suffixes, model.first, "left"), np.searchsorted(suffixes, model.last, "right")
        many = np.maximum(high - low, 0)
        return array[gather(low, many)], np.repeat(np.arange(len(many)), many)

    def relax(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of every segment (ragged) by relaxing the edges in the order of their ends.

        The last piece of the encoding of each prefix is the one edge into its end whose piece can stand after
        the last piece of the prefix before it.
        """
        model = self.model
        start, piece = self.match(symbols)
        end = start + model.lengths[piece]
        segment = np.searchsorted(starts, start, "right") - 1
        inside = end <= ends[segment]
        start, piece, end, segment = start[inside], piece[inside], end[inside], segment[inside]
        turn = end - starts[segment]
        order = np.argsort(turn, kind="stable")
        start, piece, end, turn, origin = start[order], piece[order], end[order], turn[order], starts[segment[order]]
        last = np.full(len(symbols) + 1, -1)
        cuts = np.flatnonzero(np.concatenate(([True], turn[1:] != turn[:-1]))) if len(turn) else np.zeros(0, int)
        for a, b in zip(cuts, np.append(cuts[1:], len(turn))):
            before = last[start[a:b]]
            fits = start[a:b] == origin[a:b]
            inner = np.flatnonzero(~fits & (before >= 0))
            fits[inner] = self.stands(before[inner], piece[a:b][inner])
            last[end[a:b][fits]] = piece[a:b][fits]
            # ``last`` is indexed by end; a segment's first position is never an end inside the segment before it
        steps, at, rows = [], ends.copy(), np.arange(len(starts))
        while len(rows):
            steps.append((rows, last[at[rows]]))
            at[rows] -= model.lengths[last[at[rows]]]
            rows = rows[at[rows] > starts[rows]]
        row = np.concatenate([r for r, _ in steps]) if steps else np.zeros(0, int)
        found = np.concatenate([p for _, p in steps]) if steps else np.zeros(0, int)
        back = np.lexsort((-np.arange(len(row)), row))
        return model.ids[found[back]], np.bincount(row, minlength=len(starts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of all texts (ragged) and for each text where its ids begin."""
        model = self.model
        data, offsets = text_buffers(texts)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        text_at = np.searchsorted(heads, offsets)
        filled = np.flatnonzero(np.diff(text_at))
        if not len(filled):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.insert(np.where(points == 32, ord(SPACE), points), text_at[filled], ord(SPACE)).astype(np.uint32)
        begin = text_at[:-1] + np.concatenate(([0], np.cumsum(np.diff(text_at) > 0)))[:-1]
        symbols = model.symbol[points]
        # no piece reaches over a bigram that is inside no piece
        head = np.ones(len(points), bool)
        head[1:] = ~model.inner[symbols[:-1], symbols[1:]]
        head[begin[filled]] = True
        starts = np.flatnonzero(head)
        ends = np.append(starts[1:], len(points))
        keys, at, inverse = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        if self.size > CACHE_SYMBOLS:
            self._forget()
        place = np.array([self.known.get(k, -1) for k in keys.tolist()])
        new = np.flatnonzero(place < 0)
        if len(new):
            self._learn(points, symbols, starts[at[new]], ends[at[new]])
            place[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(keys[new].tolist(), place[new].tolist()))
        limits = np.array(self.begin)
        if len(self.found) > 1:
            self.found = [np.concatenate(self.found)]
        sizes = (limits[place + 1] - limits[place])[inverse]
        ids = self.found[0][gather(limits[place][inverse], sizes)]
        sums = np.concatenate(([0], np.cumsum(sizes)))
        return ids, sums[np.searchsorted(starts, np.append(begin, len(points)))]

    def _learn(self, points: np.ndarray, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        lengths = ends - starts
        known = symbols[starts] > 0  # a code point of no piece is a segment of its own
        each = np.zeros(len(starts), np.int64)
        text = symbols[gather(starts[known], lengths[known])]
        # a break after every segment, so that no piece is found across
        begin = np.cumsum(lengths[known]) - lengths[known] + np.arange(known.sum())
        joined = np.zeros(len(text) + known.sum(), np.uint16)
        joined[gather(begin, lengths[known])] = text
        ids, each[known] = self.relax(joined, begin, begin + lengths[known])
        raw = [chr(c).encode() for c in points[starts[~known]].tolist()]
        each[~known] = [len(r) for r in raw]
        out = np.zeros(each.sum(), np.int32)
        where = np.cumsum(each) - each
        out[gather(where[known], each[known])] = ids
        out[gather(where[~known], each[~known])] = self.model.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        self.begin.extend((self.begin[-1] + np.cumsum(each)).tolist())
        self.found.append(out)
        self.size += int(lengths.sum())


class Decoder:
    """Bytes of every piece, laid out for gathering."""

    def __init__(self, model: PieceModel):
        self.data = np.frombuffer(b"".join(model.bytes), np.uint8)
        self.sizes = np.array([len(b) for b in model.bytes])
        self.begin = np.cumsum(self.sizes) - self.sizes

    def decode(self, lists: pa.Array) -> list[str | None]:
        out = []
        for ids in lists:
            if not ids.is_valid:
                out.append(None)
                continue
            ids = np.asarray(ids.values.drop_null(), np.int64) if len(ids) else np.zeros(0, np.int64)
            ids = ids[(ids >= 0) & (ids < len(self.sizes))]
            text = self.data[gather(self.begin[ids], self.sizes[ids])].tobytes()
            out.append(text.removeprefix(b" ").decode("utf-8", "replace"))
        return out


def _encoded(frame: DataFrame, model_path: str, text: str, ids: str, out: str | None = None) -> DataFrame:
    spark = prepare(frame.sparkSession)
    frame = frame.drop(ids, *([out] if out else []))
    model = spark.sparkContext.broadcast(PieceModel(model_path))  # as large as the vocabulary

    def work(batch: pa.RecordBatch, state: tuple[Encoder, Decoder]) -> dict:
        encoder, decoder = state
        flat, begin = encoder.encode(batch.column(text))
        lists = pa.ListArray.from_arrays(begin.astype(np.int32), flat)
        return dict(enumerate([*batch.columns, lists, *([pa.array(decoder.decode(lists), pa.string())] if out else [])]))

    schema = with_field(frame.schema, ids, "array<int>")
    if out:
        schema = with_field(schema, out, "string")
    return map_text(frame, work, schema, text, setup=lambda: (Encoder(model.value), Decoder(model.value)), limit=SLICE_BYTES)


def encode_pieces(frame: DataFrame, model_path: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """All columns of ``frame`` and ``ids``, the array of piece ids of the whole text; a column of that name is replaced.

    Ids equal those of the model's own library without begin and end pieces. A null or empty text gives an empty
    array; repeated rows are encoded alike. A task matches the new distinct segments of SLICE_BYTES of text at once (or of
    one longer text), in one concatenated text. Segments are recognised by a 64-bit hash.
    """
    return _encoded(frame, model_path, text, ids)


def encode_and_decode(frame: DataFrame, model_path: str, text: str = "text", ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """What ``decode_pieces`` gives after ``encode_pieces``, in one Python worker a task instead of two at once."""
    return _encoded(frame, model_path, text, ids, out)


def decode_pieces(frame: DataFrame, model_path: str, ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """All columns of ``frame`` and ``out``, the text of the piece ids; a column of that name is replaced.

    Control pieces, null ids and ids outside the vocabulary give nothing, bytes that are no UTF-8 a replacement
    character, an empty array an empty text, null stays null.
    """
    spark = prepare(frame.sparkSession)
    frame = frame.drop(out)
    decoder = spark.sparkContext.broadcast(Decoder(PieceModel(model_path)))
    schema = with_field(frame.schema, out, "string")
    arrow = to_arrow_schema(schema)

    def work(batches):
        for batch in batches:
            texts = pa.array(decoder.value.decode(batch.column(ids)), arrow.field(out).type)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], schema=arrow)

    return frame.mapInArrow(work, schema)


def round_trip(frame: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_pieces``, ``piece_ids``, and ``same`` (decoding gives the text back).

    The space sign U+2581 of the model cannot be told from a space, so texts are compared with it written as one.
    """
    both = encode_and_decode(frame.select(key, text), model_path, text)
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), SPACE, " ")
    return both.select(key, F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", (F.col("decoded") == plain).alias("same"))
