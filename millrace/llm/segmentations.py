"""SentencePiece encoding and decoding, with sampled segmentations by Gumbel top-k.

Vocabulary and pieces are those of a .model file; each piece gets a log weight, and the lattice of
a text is all ways to cut it into pieces. Of the product of these weights, ``k`` different
segmentations are drawn without replacement: a path's perturbed score is a Gumbel value around its
log probability, a prefix has the largest score of its extensions, and A* search takes the best
prefix next. As a prefix's score is exact, the search goes down one best path, and leaves behind
at each step the score of the best way not taken, a Gumbel value cut off at the path's own; the
next segmentation starts at the largest score left behind, and the largest one after the last
segmentation is the threshold. With it, a segmentation of probability p was included with
probability 1 - exp(-exp(log p - threshold)).

All random numbers are hashes of the seed, the row's key and the place of the step, so a row gives
the same segmentations in any partition and run.

As in the library, white space " " is written as U+2581, and a text gets one in front. Pieces
don't cross the border before a word's white space, and that is the only border: a text without
spaces is one unit, whatever its length. Normalisers and paths advance in all units together, a
step at a time, so long units cost steps, and memory stays that of their bytes. Characters without
a piece are spelled in byte pieces.

Nulls: a null or empty text has one segmentation, without pieces. Keys of any type are hashed for
the seed; a null key has a seed of its own. Equal rows get equal segmentations. A text with fewer than ``k`` segmentations has all of them. Empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import mapped
from .words import Prefix, U, byte_table, mix, raw, slices

#: Steps of paths that are kept singly before they are laid together.
STEPS = 1024
SLICE_BYTES = 3 << 17
MASK = (1 << 64) - 1
MARK = "▁".encode()


class Vocabulary:
    """Pieces of a model by the hash of their bytes, with " " for U+2581, and their log weights:
    ``alpha`` times the logarithm of a Zipf law in the order of the model's scores."""

    def __init__(self, path: str, alpha: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces: list[bytes] = []
        plain, scores = [], []
        self.byte_ids = np.full(256, max(model.unk_id(), 0), np.int32)  # without pieces for bytes, the unknown piece stands for each
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.pieces.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.pieces.append(b"")
            else:
                data = piece.encode().replace(MARK, b" ")
                self.pieces.append(data)
                if b" " not in data.lstrip(b" "):
                    plain.append(i)
                    scores.append(model.get_score(i))
        rank = np.empty(len(plain))
        rank[np.argsort(-np.array(scores), kind="stable")] = np.arange(1, len(plain) + 1)
        norm = np.log((1 / np.arange(1, len(plain) + 257)).sum())
        self.weight = np.full(size, -alpha * (np.log(len(plain) + 256) + norm))
        self.weight[plain] = -alpha * (np.log(rank) + norm)
        # pieces and their beginnings; the latter have no id
        known: dict[bytes, int] = {self.pieces[i][:n]: -1 for i in plain for n in range(1, len(self.pieces[i]))}
        known.update((self.pieces[i], i) for i in plain)
        data = b"".join(known)
        lengths = np.array([len(x) for x in known])
        ends = np.cumsum(lengths)
        hashes = Prefix(byte_table(False)[np.frombuffer(data, np.uint8)]).of(ends - lengths, ends)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(list(known.values()), np.int32)[order]
        self.longest = int(lengths.max())
        # where the hashes with the same upper bits start, and how many there are at most
        upper = (self.hashes >> U(44)).astype(np.int64)
        self.start = np.searchsorted(upper, np.arange(1 << 20)).astype(np.int32)
        self.chain = int(np.bincount(upper).max())
        self.hashes = np.append(self.hashes, np.zeros(self.chain, U))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the hashes of pieces and beginnings of pieces, and the pieces' ids (-1 for the others)."""
        where = self.start[(hashes >> U(44)).astype(np.int64)]
        good = self.hashes[where] == hashes
        for _ in range(1, self.chain):
            later = np.flatnonzero(~good & (self.hashes[where] < hashes) & (self.hashes[where] > 0))
            if not len(later):
                break
            where[later] += 1
            good[later] = self.hashes[where[later]] == hashes[later]
        at = np.flatnonzero(good)
        return at, self.ids[where[at]]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.pieces[i] for i in ids)[1:].decode("utf-8", "replace")


def units(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the units of strings laid end to end, and the end of all."""
    n = len(data)
    space = data == 32
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    border[1:n] |= space[1:] & ~space[:-1]
    border[n] = True
    return np.flatnonzero(border)


class Lattice:
    """Lattices of the distinct units of some strings. Nodes are bytes of the distinct units;
    edges of a node are together, the longest first: ``to`` (bytes covered), ``piece``, ``log``
    (log probability given the node) and ``cum`` (cumulative probability)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary):
        at = units(data, offsets)
        self.start, end = at[:-1], at[1:]
        name = Prefix(byte_table(False)[data]).of(self.start, end)
        _, first, self.of = np.unique(name, return_index=True, return_inverse=True)
        size = (end - self.start)[first]
        self.base = np.append(0, np.cumsum(size))  # of each distinct unit
        n = int(self.base[-1])
        node = np.arange(n, dtype=np.int32)
        owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
        text = data[self.start[first][owner] + node - self.base[owner]]
        room = (self.base[owner + 1] - node).astype(np.int32)
        prefix = Prefix(byte_table(False)[text])
        begins = (text & 0xC0) != 0x80
        nodes, lengths, ids = [], [], []
        open_nodes = node[begins]
        for length in range(1, min(vocabulary.longest, int(size.max(initial=0))) + 1):
            open_nodes = open_nodes[room[open_nodes] >= length]
            if not len(open_nodes):
                break
            open_, piece = vocabulary.find(prefix.of(open_nodes, open_nodes + length))
            open_nodes = open_nodes[open_]  # others can't become pieces
            hit = piece >= 0
            nodes.append(open_nodes[hit])
            lengths.append(np.full(len(nodes[-1]), length, np.int32))
            ids.append(piece[hit])
        width = np.where(text >= 0xF0, 4, np.where(text >= 0xE0, 3, np.where(text >= 0xC0, 2, 1)))
        width = np.minimum(width, room)
        found_node, found_length = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (nodes, lengths))
        spelled = begins.copy()
        spelled[found_node[found_length == width[found_node]]] = False
        owner_char = np.maximum.accumulate(np.where(begins, node, 0))
        single = node[spelled[owner_char]] if n else node
        # edges of a node together, the longest first
        join = lambda found, own: np.concatenate([*found[::-1], own])
        starts, covers, named = join(nodes, single), join(lengths, np.ones(len(single), np.int32)), join(ids, vocabulary.byte_ids[text[single]])
        order = np.argsort(starts, kind="stable")
        starts, covers, named = starts[order], covers[order], named[order]

        # normalisers, from the units' ends: nodes with r bytes to go need those with fewer
        left = room[starts]
        order = np.argsort(left.astype(np.uint8 if size.max(initial=0) < 256 else np.int32), kind="stable")
        here, behind = starts[order], np.where(left == covers, n, starts + covers)[order]
        score = vocabulary.weight[named[order]]
        total = np.full(n + 1, -np.inf)
        total[n] = 0.0
        fresh = np.flatnonzero(np.append(True, here[1:] != here[:-1])) if len(here) else here
        counts = np.diff(np.append(fresh, len(here)))
        levels = np.append(np.flatnonzero(np.diff(left[order], prepend=0)), len(order))
        group = np.searchsorted(fresh, levels)
        for low, high, first_group, last_group in zip(levels[:-1], levels[1:], group[:-1], group[1:], strict=True):
            part = score[low:high]
            part += total[behind[low:high]]
            begin = fresh[first_group:last_group] - low
            most = np.maximum.reduceat(part, begin)
            most[most == -np.inf] = 0.0
            with np.errstate(divide="ignore"):
                total[here[low:high][begin]] = most + np.log(np.add.reduceat(np.exp(part - np.repeat(most, counts[first_group:last_group])), begin))
        log = np.empty(len(score))
        with np.errstate(invalid="ignore"):
            log[order] = score - total[here]
        good = np.isfinite(log)
        if not good.all():
            starts, covers, named, log = starts[good], covers[good], named[good], log[good]
        self.node, self.to, self.piece, self.log = starts, covers, named, np.minimum(log, 0.0)
        self.first = np.append(0, np.cumsum(np.bincount(self.node, minlength=n)))
        chance = np.exp(self.log)
        # in whole 2**-40, so that a node's sums don't depend on the nodes before it
        sums = np.append(0, np.cumsum((chance * (1 << 40)).astype(np.int64)))
        self.cum = (sums[1:] - sums[self.first[self.node]]) / (1 << 40)
        self.cum[self.first[1:][np.diff(self.first) > 0] - 1] = 2.0
        self.other = np.log1p(-chance, where=chance < 1, out=np.full(len(chance), -np.inf))


def uniform(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from a key and a place."""
    return ((mix(key + place * U(0x9E3779B97F4A7C15)) >> U(11)).astype(np.float64) + 0.5) / (1 << 53)


def below(centre: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel value around ``centre``, given that it is at most ``top``."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        value = centre - np.log(np.exp(centre - top) - np.log(u))
    return np.where(np.isfinite(centre), np.minimum(value, top), -np.inf)


def _together(tokens: list[np.ndarray], edges: list[np.ndarray], step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, edges and steps of some steps, the first of which is ``step``."""
    return np.concatenate(tokens), np.concatenate(edges), np.repeat(np.arange(step, step + len(tokens)), [len(t) for t in tokens])


class Paths:
    """One path for each of some rows, from a unit and a node in it to the row's end."""

    def __init__(self, lattice: Lattice, key: np.ndarray, unit: np.ndarray, node: np.ndarray, last: np.ndarray, base: np.ndarray, top: np.ndarray, stream: int, keep: int):
        """``unit`` to ``last``: the units (of the strings) that are left of each row; ``node``: where
        in the first; ``base``: the log probability of what stands before; ``top``: the path's score."""
        counts = np.maximum(last - unit, 0)
        row = np.repeat(np.arange(len(unit)), counts)
        within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = unit[row] + within
        position = lattice.base[lattice.of[at]].copy()
        end = lattice.base[lattice.of[at] + 1]
        lead = within == 0
        position[lead] = node[row[lead]]
        token, step = np.flatnonzero(position < end), 0
        seeds = mix(key[row] + (last[row] - at).astype(U) * U(0xD1B54A32D192ED03) + U(stream * 0x94D049BB133111EB & MASK))  # units are numbered from the row's end
        tokens, edges, done = [], [], []
        while len(token):
            u = uniform(seeds[token], np.full(len(token), 2 * step, U))
            edge = lattice.first[position[token]]
            miss = np.flatnonzero(u >= lattice.cum[edge])
            while len(miss):
                edge[miss] += 1
                miss = miss[u[miss] >= lattice.cum[edge[miss]]]
            tokens.append(token)
            edges.append(edge)
            if len(tokens) == STEPS:
                done.append(_together(tokens, edges, step + 1 - STEPS))
                tokens, edges = [], []
            position[token] += lattice.to[edge]
            token = token[position[token] < end[token]]
            step += 1
        per_token = np.zeros(len(row) + 1, np.int64)
        if tokens:
            done.append(_together(tokens, edges, step - len(tokens)))
        for t, _, _ in done:
            per_token[1:] += np.bincount(t, minlength=len(row))
        place = np.cumsum(per_token)
        self.edge = np.empty(int(place[-1]), np.int64)
        numbers = np.empty(int(place[-1]), U)
        for t, e, i in done:
            self.edge[place[t] + i] = e
            numbers[place[t] + i] = mix(seeds[t] + (2 * i + 1).astype(U) * U(0x9E3779B97F4A7C15))
        border = np.append(0, np.cumsum(counts))
        self.bound = place[border]  # of each row's steps
        log = lattice.log[self.edge]
        sums = np.append(0.0, np.cumsum(log))
        owner = np.repeat(np.arange(len(unit)), np.diff(self.bound))
        self.before = base[owner] + (sums[:-1] - sums[self.bound[:-1]][owner])
        self.log = base + sums[self.bound[1:]] - sums[self.bound[:-1]]
        self.unit_of = np.repeat(at, np.diff(place))
        u = ((numbers >> U(11)).astype(np.float64) + 0.5) / (1 << 53)
        left = below(self.before + lattice.other[self.edge], top[owner], u)
        # the ``keep`` largest scores that each row leaves behind
        self.best: list[list[tuple[float, int]]] = [[] for _ in unit]
        full = np.flatnonzero(np.diff(self.bound) > 0)
        for _ in range(keep):
            if not len(full):
                break
            most = np.maximum.reduceat(left, self.bound[full]) if full[-1] == len(unit) - 1 else np.maximum.reduceat(np.append(left, -np.inf), self.bound[full])
            top_of = np.full(len(unit), np.nan)
            top_of[full] = most
            where = np.flatnonzero(left == top_of[owner])
            _, only = np.unique(owner[where], return_index=True)
            for i in where[only].tolist():
                if left[i] > -np.inf:
                    self.best[owner[i]].append((float(left[i]), i))
            left[where[only]] = -np.inf


def sample(texts: pa.Array, keys: np.ndarray, vocabulary: Vocabulary, k: int, seed: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text, its segmentations by falling score: ids, log probability, score, threshold."""
    data, offsets = spaced(texts)
    rows = len(offsets) - 1
    out: list[list[tuple[np.ndarray, float, float, float]]] = [[] for _ in range(rows)]
    key = mix(keys.astype(np.int64).view(U) + U(seed * 0xBF58476D1CE4E5B9 & MASK))
    full = np.flatnonzero(np.diff(offsets) > 0)
    for i in np.flatnonzero(np.diff(offsets) == 0):
        out[i].append((np.zeros(0, np.int64), 0.0, 0.0, -np.inf))
    if not len(full):
        return out
    lattice = Lattice(data, offsets, vocabulary)
    unit = np.searchsorted(lattice.start, offsets[:-1][full])
    last = np.append(unit[1:], len(lattice.start))
    key = key[full]
    root = -np.log(-np.log(uniform(key, np.full(len(full), 7, U))))
    zero = np.zeros(len(full))
    paths = [Paths(lattice, key, unit, lattice.base[lattice.of[unit]], last, zero, root, 0, k)]
    # per row: (score, path, its number in the path, step, edges not to take), and the found paths as (path, number, steps of the parent)
    waiting = [[(s, 0, i, at, ()) for s, at in best] for i, best in enumerate(paths[0].best)]
    found = [[(0, i, None, float(root[i]))] for i in range(len(full))]
    for turn in range(1, k):
        todo = []
        for i, heap in enumerate(waiting):
            if heap:
                heap.sort(reverse=True)
                todo.append((i, *heap.pop(0)))
        if not todo:
            break
        starts = []
        for i, score, p, number, at, banned in todo:
            path = paths[p]
            banned = (*banned, int(path.edge[at])) if not banned else banned
            node = lattice.node[banned[0]]
            edges = np.arange(lattice.first[node], lattice.first[node + 1])
            edges = edges[~np.isin(edges, banned)]
            u = uniform(np.full(len(edges), key[i]), (edges - lattice.first[node]).astype(U) + U(1000 * turn))
            with np.errstate(divide="ignore"):
                edge = int(edges[np.argmax(lattice.log[edges] - np.log(-np.log(u)))])
            rest = edges[edges != edge]
            if len(rest):
                mass = path.before[at] + np.log(np.exp(lattice.log[rest]).sum())
                u = uniform(key[i : i + 1], np.full(1, 1000 * turn + 999, U))
                waiting[i].append((float(below(np.array([mass]), np.array([score]), u)[0]), p, number, at, (*banned, edge)))
            starts.append((int(path.unit_of[at]), int(node + lattice.to[edge]), float(path.before[at] + lattice.log[edge]), edge))
        index = np.array([x[0] for x in todo])
        at_unit = np.array([s[0] for s in starts])
        node = np.array([s[1] for s in starts])
        new = Paths(lattice, key[index], at_unit, node, last[index], np.array([s[2] for s in starts]), np.array([x[1] for x in todo]), turn, k)
        paths.append(new)
        for number, ((i, score, p, parent, at, _), start) in enumerate(zip(todo, starts, strict=True)):
            found[i].append((turn, number, (p, parent, at, start[3]), score))
            waiting[i] += [(s, turn, number, j, ()) for s, j in new.best[number]]
    steps: dict[tuple[int, int], np.ndarray] = {}
    for i, row in enumerate(full):
        threshold = max((x[0] for x in waiting[i]), default=-np.inf)
        for p, number, parent, score in found[i]:
            path = paths[p]
            own = path.edge[path.bound[number] : path.bound[number + 1]]
            if parent:
                q, above, at, edge = parent
                whole = steps[(q, above)]
                lead = len(whole) - (paths[q].bound[above + 1] - at)
                own = np.concatenate([whole[:lead], [edge], own])
            steps[(p, number)] = own
            out[row].append((lattice.piece[own], float(path.log[number]), score, float(threshold)))
    return out


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets with a space in front of each text that isn't empty, and " " for U+2581."""
    data, offsets = raw(texts)
    mark = np.flatnonzero((data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2])) if len(data) > 2 else np.zeros(0, np.int64)
    if len(mark):
        keep = np.ones(len(data), bool)
        keep[mark + 1] = keep[mark + 2] = False
        data = np.where(np.isin(np.arange(len(data)), mark), 32, data).astype(np.uint8)
        offsets = np.append(0, np.cumsum(keep))[offsets]
        data = data[keep]
    full = np.diff(offsets) > 0
    return np.insert(data, offsets[:-1][full], 32), offsets + np.append(0, np.cumsum(full))


def sampled(docs: DataFrame, model: str, *, text: str = "text", key: str = "doc_id", k: int = 2, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """``key``, rank (from 1), ids, log_prob, score, and inclusion (probability of being among the
    ``k``) of each segmentation. ``model``: the path of a .model file on every machine."""
    rows = docs.select(F.col(key).alias("_id"), F.xxhash64(F.col(key)).alias("_seed"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model, alpha)
        for batch in slices(batches, "_text", SLICE_BYTES):
            found = sample(batch.column("_text"), batch.column("_seed").to_numpy(), vocabulary, k, seed)
            take = np.repeat(np.arange(len(found)), [len(x) for x in found])
            flat = [x for row in found for x in row]
            lengths = np.append(0, np.cumsum([len(x[0]) for x in flat])).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate([x[0] for x in flat]).astype(np.int32)))
            log, score, threshold = (np.array([x[j] for x in flat]) for j in (1, 2, 3))
            with np.errstate(over="ignore"):
                inclusion = -np.expm1(-np.exp(log - threshold))
            rank = np.concatenate([np.arange(1, len(x) + 1) for x in found]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take)), pa.array(rank), ids, pa.array(log), pa.array(score), pa.array(inclusion)], ["_id", "rank", "ids", "log_prob", "score", "inclusion"])

    kind = rows.schema["_id"].dataType.simpleString()
    return mapped(rows, run, f"_id {kind}, rank int, ids array<int>, log_prob double, score double, inclusion double").withColumnRenamed("_id", key)


def decoded(encoded: DataFrame, model: str, *, ids: str = "ids", into: str = "text") -> DataFrame:
    """``encoded`` with the texts of its piece ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        for batch in batches:
            texts = [vocabulary.decode(x) if x is not None else None for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return mapped(encoded, run, f"{columns}, `{into}` string")
