"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is the composition of

* the normaliser: spaces become the space symbol, with one before every text; with the
  model's flag, runs of spaces become one and those at the ends go;
* the pieces: a trie whose paths spell pieces and put out their ids; a character that is
  no piece falls back to the ids of its UTF-8 bytes (or to the unknown id);
* the weights. For a unigram model a piece costs its negative score. A BPE model's own
  scores are merge ranks and say nothing about sums along a path; its language is instead
  given by pairs: a sequence of pieces is the BPE encoding of its text if and only if
  every two adjacent pieces are the encoding of their own two texts joined. So pieces cost
  nothing, and two adjacent ones cost nothing or infinity.

An input is composed with it as a lattice of arcs (text, begin, end, piece), and the path of
least cost in the tropical semiring (least sum) is its encoding. In BPE exactly one path
is finite.

Texts are cut between characters that stand together in no piece; no piece crosses such a
place. Different parts are few compared to all, so a bounded cache keeps their ids, and
the lattices of all missing parts of a block are solved together, one position a step.

Defined results: null and empty texts have no ids and decode to an empty text; decoding
returns the normalised text, so leading and trailing spaces stay where the model keeps
them; invalid bytes among fallback ids decode to U+FFFD; control and unused pieces never
come out of an encoding and decode to nothing; models with a character map are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import Shared, table

SPACE = 0x2581
BLOCK_CHARS = 1 << 19
DENSE_CHARS = 256
GROUP_CELLS = 1 << 17
CACHED_PARTS = 600_000
CACHED_PAIRS = 1_000_000

_U = np.uint64


class PieceModel:
    """Pieces, scores and flags of a model file, and what the transducer needs of them."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            proto = pb.ModelProto.FromString(f.read())
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap:
            raise ValueError("models with a character map are not covered")
        self.prefix, self.collapse = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.bpe = proto.trainer_spec.model_type == 2
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        n = sp.vocab_size()
        self.unknown = sp.unk_id()
        self.bytes = np.full(256, self.unknown)
        self.text: list[bytes] = []
        own: dict[str, int] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unused(i):
                self.text.append(b"")
            elif i == self.unknown:
                self.text.append(" ⁇ ".encode())
            else:
                own[piece] = i
                self.text.append(piece.encode())
        self.pieces = own
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self._trie()
        if self.bpe:
            self._merges()

    def _trie(self) -> None:
        """Nodes and edges; characters of the first ``DENSE_CHARS`` code points have a table."""
        edges: dict[tuple[int, int], int] = {}
        ends = [-1]
        pairs = set()
        for piece, i in self.pieces.items():
            node = 0
            codes = list(map(ord, piece))
            pairs.update(zip(codes, codes[1:]))
            for c in codes:
                nxt = edges.get((node, c))
                if nxt is None:
                    nxt = edges[node, c] = len(ends)
                    ends.append(-1)
                node = nxt
            ends[node] = i
        self.ends = np.array(ends)
        keys = np.array([n * (1 << 21) + c for n, c in edges], np.int64)
        to = np.fromiter(edges.values(), np.int64, len(edges))
        order = np.argsort(keys)
        self.edge_keys, self.edge_to = keys[order], to[order].astype(np.int32)
        self._tabulate()
        self.pair_keys = np.sort(np.array([a * (1 << 21) + b for a, b in pairs], np.int64))
        self.pair_dense = np.zeros((DENSE_CHARS + 1, DENSE_CHARS + 1), bool)
        x, y = (self._column(z) for z in np.divmod(self.pair_keys, 1 << 21))
        both = (x >= 0) & (y >= 0)
        self.pair_dense[x[both], y[both]] = True

    def _tabulate(self) -> None:
        """Edges of common characters as a table; the space symbol takes its last column."""
        nodes, codes = np.divmod(self.edge_keys, 1 << 21)
        columns = self._column(codes)
        common = columns >= 0
        inner = np.unique(nodes[common])
        self.row = np.zeros(len(self.ends), np.int32)  # row 0: no edges
        self.row[inner] = np.arange(1, len(inner) + 1)
        self.dense = np.full((len(inner) + 1, DENSE_CHARS + 1), -1, np.int32)
        self.dense[self.row[nodes[common]], columns[common]] = self.edge_to[common]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "dense"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._tabulate()

    @staticmethod
    def _column(codes: np.ndarray) -> np.ndarray:
        """The table's column of a code point, -1 if it has none."""
        return np.where(codes < DENSE_CHARS, codes, np.where(codes == SPACE, DENSE_CHARS, -1))

    def step(self, nodes: np.ndarray, codes: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """The next trie nodes, -1 where there is no edge."""
        out = self.dense[self.row[nodes], columns]
        rare = np.flatnonzero(columns < 0)
        if len(rare):
            keys = nodes[rare].astype(np.int64) * (1 << 21) + codes[rare]
            at = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
            out[rare] = np.where(self.edge_keys[at] == keys, self.edge_to[at], -1)
        return out

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether two characters stand together in some piece."""
        x, y = self._column(a), self._column(b)
        out = self.pair_dense[x, y]
        rare = np.flatnonzero((x < 0) | (y < 0))
        if len(rare):
            keys = a[rare].astype(np.int64) * (1 << 21) + b[rare]
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            out[rare] = self.pair_keys[at] == keys
        return out

    def bpe_pieces(self, text: str) -> list[str]:
        """BPE by its definition: join the best neighbours, the left ones in a tie."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -np.inf, -1
            for i in range(len(parts) - 1):
                k = self.pieces.get(parts[i] + parts[i + 1])
                if k is not None and self.score[k] > best:
                    best, at = self.score[k], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merges(self) -> None:
        """Each piece's last merge, the pieces no merging makes, and the rank of each."""
        n = len(self.score)
        self.rank = np.empty(n, np.int64)
        self.rank[np.argsort(-self.score, kind="stable")] = np.arange(n)
        values, counts = np.unique(self.score, return_counts=True)
        self.tied = np.isin(self.score, values[counts > 1])
        self.left, self.right = np.arange(n), np.arange(n)
        self.reached = np.zeros(n, bool)
        merge_keys, merge_to = [], []
        self.names = [""] * n
        for piece, i in self.pieces.items():
            self.names[i] = piece
            if len(piece) == 1:
                self.reached[i] = True
                continue
            for cut in range(1, len(piece)):
                a, b = self.pieces.get(piece[:cut]), self.pieces.get(piece[cut:])
                if a is not None and b is not None:
                    merge_keys.append(a * n + b)
                    merge_to.append(i)
            parts = self._last_merge(piece)
            if parts:
                self.left[i], self.right[i] = (self.pieces.get(x, -1) for x in parts)
                self.reached[i] = min(self.left[i], self.right[i]) >= 0
        order = np.argsort(merge_keys)
        self.merge_keys, self.merge_to = np.array(merge_keys)[order], np.array(merge_to)[order]

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        parts = list(piece)
        while len(parts) > 1:
            best, at = -np.inf, -1
            for i in range(len(parts) - 1):
                k = self.pieces.get(parts[i] + parts[i + 1])
                if k is not None and self.score[k] > best:
                    best, at = self.score[k], i
            if at < 0:
                return None
            if len(parts) == 2:
                return parts[0], parts[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return None

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the encoding of the joined texts of two pieces is these two pieces.

        Undoes merges from both sides of the boundary, the latest first: the pair fails if
        two parts at the boundary would have merged before the part that replaced them.
        """
        n = len(self.score)
        a, b = a.copy(), b.copy()
        out = np.ones(len(a), bool)
        exact = np.flatnonzero(self.tied[a] | self.tied[b])
        for i in exact:  # pieces of equal score, runs of spaces: by the definition
            x, y = self.names[a[i]], self.names[b[i]]
            out[i] = self.bpe_pieces(x + y) == [x, y]
        live = np.setdiff1d(np.arange(len(a)), exact)
        limit = np.full(len(a), n + 1)
        while len(live):
            x, y = a[live], b[live]
            keys = x * n + y
            at = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
            met = np.where(self.merge_keys[at] == keys, self.rank[self.merge_to[at]], n + 1)
            bad = met < limit[live]
            out[live[bad]] = False
            live, x, y = live[~bad], x[~bad], y[~bad]
            single_x, single_y = self.left[x] == x, self.left[y] == y
            rank_x, rank_y = np.where(single_x, -1, self.rank[x]), np.where(single_y, -1, self.rank[y])
            done = single_x & single_y
            undo_x = rank_x > rank_y
            # of equal ranks the left one merges first
            limit[live] = np.where(undo_x, rank_x, rank_y + 1)
            a[live] = np.where(undo_x, self.right[x], x)
            b[live] = np.where(undo_x, y, self.left[y])
            live = live[~done]
        return out


class PairCache:
    """Answers of ``compatible`` by pair, as sorted arrays; forgets all when it is full."""

    def __init__(self, model: PieceModel, most: int = CACHED_PAIRS):
        self.model, self.most = model, most
        self.keys, self.good = np.zeros(0, np.int64), np.zeros(0, bool)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = len(self.model.score)
        wanted = a.astype(np.int64) * n + b
        at = np.searchsorted(self.keys, wanted)
        known = np.zeros(len(wanted), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == wanted[inside]
        if known.all():
            return self.good[at]
        new = np.unique(wanted[~known])
        if len(self.keys) + len(new) > self.most:
            self.keys, self.good = np.zeros(0, np.int64), np.zeros(0, bool)
            new = np.unique(wanted)
        keys = np.r_[self.keys, new]
        good = np.r_[self.good, self.model.compatible(new // n, new % n)]
        order = np.argsort(keys, kind="stable")
        self.keys, self.good = keys[order], good[order]
        return self.good[np.searchsorted(self.keys, wanted)]


class Transducer:
    """Composes inputs with a model and takes shortest paths; keeps the ids of parts."""

    def __init__(self, model: PieceModel):
        self.model, self.pairs, self.cache = model, PairCache(model), ws.PieceCache(CACHED_PARTS)

    def normalised(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the normalised texts end to end, and each text's start."""
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][starts]
        codes = np.where(codes == 32, SPACE, codes)
        if self.model.collapse:
            space = codes == SPACE
            keep = np.ones(len(codes), bool)
            keep[1:] = ~(space[1:] & space[:-1])
            first = starts[:-1][starts[:-1] < starts[1:]]
            keep[first] = True
            codes_kept = np.r_[0, np.cumsum(keep)]
            codes, starts = codes[keep], codes_kept[starts]
            some = np.flatnonzero(starts[:-1] < starts[1:])
            drop = np.zeros(len(codes), bool)
            drop[starts[some]] |= codes[starts[some]] == SPACE
            drop[starts[some + 1] - 1] |= codes[starts[some + 1] - 1] == SPACE
            kept = np.r_[0, np.cumsum(~drop)]
            codes, starts = codes[~drop], kept[starts]
        if self.model.prefix:
            some = starts[:-1] < starts[1:]
            codes = np.insert(codes, starts[:-1][some], SPACE)
            starts = starts + np.r_[0, np.cumsum(some)]
        return codes, starts

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids end to end, ids before each text, and the normalised code points and starts."""
        codes, starts = self.normalised(data, starts)
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.model.joined(codes[:-1], codes[1:])
        begins, ends = ws.runs(np.ones(len(codes), bool), starts, cut)
        ids, counts = self.cache.encode(ws.code_hashes(codes, begins, ends), lambda at: self.shortest(codes, begins[at], ends[at]))
        return ids, np.r_[0, np.cumsum(counts)][np.searchsorted(begins, starts)], codes, starts

    def shortest(self, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the shortest path of every part, by groups of similar length."""
        lengths = ends - begins
        order = np.argsort(lengths, kind="stable")
        counts = np.zeros(len(begins), np.int64)
        found: list[np.ndarray] = []
        a = 0
        while a < len(order):
            b = a + 1
            while b < len(order) and (b - a + 1) * lengths[order[b]] <= GROUP_CELLS:
                b = min(len(order), b + 4096)
            b = max(a + 1, min(b, a + GROUP_CELLS // max(1, int(lengths[order[b - 1]]))))
            rows = order[a:b]
            counts[rows], ids = self._group(codes, begins[rows], lengths[rows])
            found.append(ids)
            a = b
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        # back from the order of lengths to the order asked for
        by_length = counts[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(by_length) - by_length
        return counts, flat[ws.ragged(place, counts)]

    def _group(self, codes: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        model, n, width = self.model, len(begins), int(lengths.max())
        inside = np.arange(width)[None, :] < lengths[:, None]
        part, start = np.nonzero(inside)
        chars = codes[begins[part] + start]
        columns = model._column(chars)
        first_of = np.cumsum(lengths) - lengths

        # arcs of the lattice: paths through the trie from every position
        arc_part, arc_start, arc_end, arc_piece = [], [], [], []
        node, live = np.zeros(len(part), np.int32), np.arange(len(part))
        covered = np.zeros(len(part), bool)
        depth = 0
        while len(live):
            at = live + depth
            node = model.step(node, chars[at], columns[at])
            go = node >= 0
            live, node = live[go], node[go]
            piece = model.ends[node]
            some = piece >= 0
            if model.bpe and depth:
                some &= model.reached[piece]
            arc_part.append(part[live[some]])
            arc_start.append(start[live[some]])
            arc_end.append(start[live[some]] + depth + 1)
            arc_piece.append(piece[some])
            if depth == 0:
                covered[live[some]] = True
            depth += 1
            more = start[live] + depth < lengths[part[live]]
            live, node = live[more], node[more]
        # a character that is no piece: one arc that stands for its bytes
        lone = np.flatnonzero(~covered)
        arc_part.append(part[lone])
        arc_start.append(start[lone])
        arc_end.append(start[lone] + 1)
        arc_piece.append(np.full(len(lone), -1))
        arc_part, arc_start, arc_end, arc_piece = map(np.concatenate, (arc_part, arc_start, arc_end, arc_piece))

        # by end, then from the longest arc to the shortest: of one end and rank a part has one
        order = np.lexsort((arc_start, arc_part, arc_end))
        arc_part, arc_start, arc_end, arc_piece = (x[order] for x in (arc_part, arc_start, arc_end, arc_piece))
        new = np.flatnonzero(np.r_[True, (arc_part[1:] != arc_part[:-1]) | (arc_end[1:] != arc_end[:-1])])
        rank = np.arange(len(arc_end)) - np.repeat(new, np.diff(np.r_[new, len(arc_end)]))
        bounds = np.searchsorted(arc_end, np.arange(width + 2))
        cost = np.full((n, width + 1), np.inf)
        cost[:, 0] = 0
        last = np.full((n, width + 1), -2)  # -2: the start of a part
        back = np.zeros((n, width + 1), np.int32)
        floor = model.score[list(model.pieces.values())].min() - 10
        for end in range(1, width + 1):
            here = slice(bounds[end], bounds[end + 1])
            ranks = rank[here]
            by_rank = np.argsort(ranks, kind="stable")
            cuts = np.searchsorted(ranks[by_rank], np.arange(ranks.max() + 2)) if len(ranks) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                arcs = by_rank[lo:hi] + bounds[end]
                p, s, piece = arc_part[arcs], arc_start[arcs], arc_piece[arcs]
                if model.bpe:
                    open_ = np.isinf(cost[p, end]) & ~np.isinf(cost[p, s])
                    p, s, piece = p[open_], s[open_], piece[open_]
                    before = last[p, s]
                    good = np.ones(len(p), bool)
                    both = np.flatnonzero((before >= 0) & (piece >= 0))
                    good[both] = self.pairs(before[both], piece[both])
                    p, s, piece = p[good], s[good], piece[good]
                    total = cost[p, s]
                else:
                    total = cost[p, s] - np.where(piece >= 0, model.score[piece], floor)
                    good = total < cost[p, end]
                    p, s, piece, total = p[good], s[good], piece[good], total[good]
                cost[p, end], last[p, end], back[p, end] = total, piece, s

        # read the paths backwards, one arc of every part a step
        parts, at = np.arange(n), lengths.copy()
        path_part, path_end, path_piece = [], [], []
        while len(parts):
            path_part.append(parts)
            path_end.append(at)
            path_piece.append(last[parts, at])
            at = back[parts, at].astype(np.int64)
            parts, at = parts[at > 0], at[at > 0]
        path_part, path_end, path_piece = map(np.concatenate, (path_part, path_end, path_piece))
        order = np.lexsort((path_end, path_part))
        path_part, path_end, path_piece = path_part[order], path_end[order], path_piece[order]
        lone = np.flatnonzero(path_piece < 0)
        if not len(lone):
            return np.bincount(path_part, minlength=n), path_piece
        sizes = np.ones(len(path_piece), np.int64)
        spelled = [model.bytes[np.frombuffer(chr(c).encode(), np.uint8)] for c in chars[first_of[path_part[lone]] + path_end[lone] - 1].tolist()]
        spelled = [x if (x != model.unknown).all() else np.array([model.unknown]) for x in spelled]
        sizes[lone] = [len(x) for x in spelled]
        flat = np.repeat(path_piece, sizes)
        flat[np.repeat(path_piece < 0, sizes)] = np.concatenate(spelled)
        return np.bincount(path_part, sizes, n).astype(np.int64), flat


class Decoder:
    """The pieces' bytes as one array, to be gathered by id."""

    def __init__(self, model: PieceModel):
        texts = [t.replace(chr(SPACE).encode(), b" ") for t in model.text]
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts])
        self.places = np.cumsum(self.sizes) - self.sizes
        self.prefix = model.prefix

    def decode(self, ids: np.ndarray, before: np.ndarray) -> list[bytes]:
        """The text of each run of ids ``before[i] .. before[i + 1]``, as UTF-8."""
        raw = self.bytes[ws.ragged(self.places[ids], self.sizes[ids])].tobytes()
        at = np.r_[0, np.cumsum(self.sizes[ids])][before]
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            text = raw[a + 1 : b] if self.prefix and raw[a : a + 1] == b" " and b > a else raw[a:b]
            out.append(text)
        return out


def _valid(text: bytes) -> bytes:
    try:
        text.decode()
    except UnicodeDecodeError:
        return text.decode("utf-8", "replace").encode()
    return text


def _returns(decoder: Decoder, ids, before, codes, starts) -> list[bool]:
    """Whether the ids of each text decode to its normalised text."""
    text = codes.astype("<u4").tobytes().decode("utf-32-le").replace(chr(SPACE), " ")
    wanted = [text[a + (decoder.prefix and b > a) : b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
    return [_valid(x).decode() == y for x, y in zip(decoder.decode(ids, before), wanted)]


def _encode(model, check: bool):
    @ws.released
    def encode(batches):
        transducer = Transducer(model.value)
        decoder = Decoder(transducer.model) if check else None
        for batch in batches:
            for first, last, data, starts in ws.blocks(batch.column(1), BLOCK_CHARS):
                ids, before, codes, places = transducer.encode(data, starts)
                columns = [batch.column(0).slice(first, last - first), ws.lists(ids.astype(np.int32), np.diff(before))]
                if check:
                    columns.append(pa.array(_returns(decoder, ids, before, codes, places), pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=["key", "ids", "returns"][: len(columns)])

    return encode


def _decode(shared):
    @ws.released
    def decode(batches):
        decoder = shared.value
        for batch in batches:
            lists = batch.column(1)
            counts = np.where(lists.is_valid().to_numpy(zero_copy_only=False), pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False), 0)
            texts = decoder.decode(lists.flatten().to_numpy().astype(np.int64), np.r_[0, np.cumsum(counts)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(_valid, texts), pa.binary()).cast(pa.string())], names=["key", "text"])

    return decode


def _keyed(df: DataFrame, value: str, out: str) -> DataFrame:
    """All other columns as one struct, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (value, out)]
    key = F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))
    return df.select(key.alias("key"), F.col(f"`{value}`").alias("value"))


def _unkeyed(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    return df.select(*[F.col(f"key.`{c}`") for c in columns], F.col(df.columns[1]).alias(out))


def encode_pieces(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", check_col: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``text_col`` in its place, as the array column ``ids_col``.

    ``check_col`` adds whether the ids, decoded again, give the normalised text.
    """
    model = Shared(docs.sparkSession, PieceModel(model_path))
    keyed = _keyed(docs, text_col, ids_col)
    schema = f"key {keyed.schema['key'].dataType.simpleString()}, ids array<int>" + (", returns boolean" if check_col else "")
    done = keyed.mapInArrow(_encode(model, check_col is not None), schema)
    kept = [c for c in docs.columns if c not in (text_col, ids_col, check_col)]
    return done.select(*[F.col(f"key.`{c}`") for c in kept], F.col("ids").alias(ids_col), *([F.col("returns").alias(check_col)] if check_col else []))


def decode_pieces(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of ``ids_col`` in its place."""
    decoder = Shared(encoded.sparkSession, Decoder(PieceModel(model_path)))
    keyed = _keyed(encoded, ids_col, text_col)
    done = keyed.mapInArrow(_decode(decoder), f"key {keyed.schema['key'].dataType.simpleString()}, text string")
    return _unkeyed(done, [c for c in encoded.columns if c not in (ids_col, text_col)], text_col)


def op9_sentencepiece(spark, d):
    """Ids of every whole text, and whether they decode to the normalised text."""
    import public_tokenizers

    docs = table(spark, d, "documents").select("doc_id", "text")
    encoded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), check_col="round_trip")
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip")
