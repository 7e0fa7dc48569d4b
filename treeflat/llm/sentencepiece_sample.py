"""SentencePiece encoding by sampling without replacement, and decoding.

A text's lattice has an edge for each vocabulary piece at each place; characters without a piece are spelled in byte pieces.  Two
neighbouring characters that stand together in no piece cut every path, so the lattice falls apart into short units without loss;
units that occur again are built once per run of rows.  Backward sums give each edge its conditional probability.

Sampling is Gumbel top-k: each segmentation has its log probability plus independent Gumbel noise, and the k largest are a sample without
replacement.  They are found best first (A-star) over the tree of prefixes: a node's value is the largest perturbed value below it, which
is drawn top down.  The children that a path does not take are kept as one node whose value is a Gumbel truncated at the parent's; it is
split when it is taken.  Along a path values only get smaller, and uniform numbers of 53 bits add less than ``NOISE`` to
a log probability, so places whose remaining mass cannot reach the values still needed are never drawn: the bound of the search.

The threshold is the (k+1)-th value; ``log_inclusion`` is log(1 - exp(-exp(log_prob - threshold))), the inclusion score of
importance weighted estimates.  All noise comes from a hash of (seed, row key, place), so a row's sample does not depend on its neighbours.

Scores.  A unigram model has log probabilities.  The ranks of a BPE model are taken for a Zipf law (p ~ 1 / (rank + ``ZIPF``)); byte and unused
pieces have the last rank.  Normalisation is that of the model when it is the identity: blanks become the meta symbol, one is put in front.

Defined results: null and empty texts have one segmentation, the empty one; a text with fewer than k segmentations gives all of them, with inclusion 1; null
keys are one key; rows given twice give the same sample twice.  Decoding restores the text (a meta symbol in it becomes a blank).
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from treeflat.llm.common import free_name, keyed, released, ship
from treeflat.llm.words import _powers_to, mix, slices

ship(__name__)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
META = "▁"
ZIPF = 2.7
#: Characters that are worked on together.
RUN = 600_000
NOISE = 37.0
_MASK = 2**64 - 1
_LEAF, _PLACE, _REST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95), np.uint64(0xA0761D6478BD642F)


class Vocabulary:
    """Tables of a model: characters, which of them stand together, a trie of pieces, log probabilities."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        if sp.normalize(" a  A\n") != META + META + "a" + META * 2 + "A\n":
            raise ValueError("only models with identity normalisation, a blank in front and no removal of blanks can be sampled")
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        scores = np.array([sp.get_score(i) for i in range(size)])
        if scores[plain].min() < -1000:  # ranks of merges, not log probabilities
            rank = np.where(scores < -1e8, size, -scores)
            rank[[i for i in range(size) if sp.is_byte(i) or sp.is_unknown(i)]] = size
            scores = -np.log(rank + ZIPF)
            scores -= np.log(np.exp(scores[plain]).sum())
        else:
            scores[[i for i in range(size) if sp.is_byte(i) or sp.is_unknown(i)]] = scores[plain].min() - 10
        self.log_p = scores
        self.pieces = [sp.id_to_piece(i).replace(META, " ").encode() for i in range(size)]
        for i in range(size):
            if sp.is_byte(i):
                self.pieces[i] = bytes([int(sp.id_to_piece(i)[1:-1], 16)])
            elif sp.is_control(i):
                self.pieces[i] = b""
        text = {sp.id_to_piece(i): i for i in plain}
        single = sorted(p for p in text if len(p) == 1)
        self.of = np.zeros(0x110000, np.int32)  # 0: no piece of its own
        for k, c in enumerate(single):
            self.of[ord(c)] = k + 1
        self.bytes_from = len(single) + 1
        self.width = self.bytes_from + 256
        byte_ids = {self.pieces[i][0]: i for i in range(size) if sp.is_byte(i)}
        known = set(single)
        usable = {p: i for p, i in text.items() if set(p) <= known}
        self.together = np.zeros((self.width, self.width), bool)
        nodes: dict[tuple[int, int], int] = {}
        piece_at = [-1]
        for p, i in usable.items():
            at, chars = 0, [int(self.of[ord(c)]) for c in p]
            for a, b in zip(chars, chars[1:]):
                self.together[a, b] = True
            for c in chars:
                if (at, c) not in nodes:
                    nodes[at, c] = len(piece_at)
                    piece_at.append(-1)
                at = nodes[at, c]
            piece_at[at] = i
        for b in range(256):
            nodes[0, self.bytes_from + b] = len(piece_at)
            piece_at.append(byte_ids.get(b, sp.unk_id()))
        self.piece_at = np.array(piece_at, np.int32)
        self.root = np.zeros(self.width, np.int64)
        for (at, c), to in nodes.items():
            if at == 0:
                self.root[c] = to
        # steps below the root, in a table with linear probing: (key, node), key -1 where empty
        slots = 1 << max(4, (4 * len(nodes)).bit_length())
        self.shift = np.uint64(64 - slots.bit_length() + 1)
        self.step_keys, self.step_to = np.full(slots, -1, np.int64), np.zeros(slots, np.int64)
        for (at, c), to in nodes.items():
            if at:
                key = at * self.width + c
                slot = int((key * int(_LEAF) % 2**64) >> int(self.shift))
                while self.step_keys[slot] >= 0:
                    slot = (slot + 1) % slots
                self.step_keys[slot], self.step_to[slot] = key, to
        self.char_hash = mix(np.arange(1, self.width + 1, dtype=np.uint64) * _LEAF)

    def steps(self, keys: np.ndarray) -> np.ndarray:
        """The nodes that the steps lead to; 0 where there is none."""
        out = np.zeros(len(keys), np.int64)
        on = np.arange(len(keys))
        slot = ((keys.astype(np.uint64) * _LEAF) >> self.shift).astype(np.int64)
        while len(on):
            found = self.step_keys[slot]
            hit = found == keys[on]
            out[on[hit]] = self.step_to[slot[hit]]
            more = ~hit & (found >= 0)
            on, slot = on[more], (slot[more] + 1) % len(self.step_keys)
        return out

    def characters(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Character numbers of the texts end to end (blank in front, unknown characters as bytes), and where each begins."""
        joined = "".join(" " + t if t else "" for t in texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        codes[codes == 0x20] = ord(META)
        at = slices(np.array([len(t) + 1 if t else 0 for t in texts], np.int64))
        chars = self.of[codes]
        unknown = np.flatnonzero(chars == 0)
        if len(unknown):
            spelled = [chr(c).encode("utf-8", "surrogatepass") for c in codes[unknown]]
            lengths = np.ones(len(chars), np.int64)
            lengths[unknown] = [len(s) for s in spelled]
            where = slices(lengths)
            chars = np.repeat(chars, lengths)
            chars[chars == 0] = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int32) + self.bytes_from
            at = where[at]
        return chars, at

    def decode(self, ids) -> str:
        data = b"".join(map(self.pieces.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
        return data[1:].decode("utf-8", "surrogatepass") if data[:1] == b" " else data.decode("utf-8", "surrogatepass")


def _uniform(x: np.ndarray) -> np.ndarray:
    return (mix(x) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def _uniform_of(x: int) -> float:
    """:func:`_uniform` of one number."""
    x &= _MASK
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _MASK
    return ((x ^ (x >> 31)) >> 11) * 2.0**-53 + 2.0**-54


class Lattice:
    """Edges of the distinct units: by place ``first`` to ``last``; per edge its end, piece, log probability and running probability."""

    def __init__(self, vocabulary: Vocabulary, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        lengths = ends - starts
        self.base = slices(lengths + 1)[:-1]  # one place more than characters for each unit
        flat = np.repeat(starts - slices(lengths)[:-1], lengths) + np.arange(int(lengths.sum()))
        text = np.zeros(int((lengths + 1).sum()), np.int64)
        place = np.repeat(self.base - slices(lengths)[:-1], lengths) + np.arange(int(lengths.sum()))
        text[place] = chars[flat]
        left = np.zeros(len(text), np.int64)  # characters to the end of the unit
        left[place] = np.repeat(lengths, lengths) - (place - np.repeat(self.base, lengths))
        found, at, node, depth = [], place, vocabulary.root[text[place]], 1
        while len(at):
            piece = vocabulary.piece_at[node]
            has = piece >= 0
            found.append((at[has], depth, piece[has]))
            on = left[at] > depth
            at, node = at[on], node[on]
            node = vocabulary.steps(node * vocabulary.width + text[at + depth])
            on = node > 0
            at, node, depth = at[on], node[on], depth + 1
        count = np.zeros(len(text), np.int64)
        for p, _, _ in found:
            count[p] += 1
        offset = slices(count)
        self.first, self.last = offset[:-1], offset[1:] - 1
        edges = int(offset[-1])
        self.end, self.piece, place_of = np.empty(edges, np.int64), np.empty(edges, np.int32), np.empty(edges, np.int64)
        fill = self.first.copy()
        for p, d, i in found:
            e = fill[p]
            fill[p] += 1
            self.end[e], self.piece[e], place_of[e] = p + d, i, p
        # backward sums, the places nearest to the end of their unit first
        score = vocabulary.log_p[self.piece]
        total = np.zeros(len(text))
        to_end = left[place]
        order = place[np.argsort(to_end.astype(np.uint16) if len(lengths) and lengths.max() < 2**16 else to_end, kind="stable")]  # short numbers sort in linear time
        cuts = slices(np.bincount(left[order]))
        for d in range(1, len(cuts) - 1):
            mine = order[cuts[d] : cuts[d + 1]]
            n = count[mine]
            at = slices(n)[:-1]
            e = np.repeat(self.first[mine] - at, n) + np.arange(int(n.sum()))
            x = score[e] + total[self.end[e]]
            top = np.maximum.reduceat(x, at)
            total[mine] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, n)), at))
        self.place = place_of
        self.log_q = np.minimum(score + total[self.end] - total[place_of], 0.0)
        self.q = np.exp(self.log_q)
        sums = np.cumsum(self.q)
        self.running = sums - (sums - self.q)[self.first[place_of]]
        self.running[self.last[place]] = np.inf  # whatever rounding leaves falls on the last edge
        self.alone = (self.first == self.last)[place_of]

    def pick(self, place: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge at each place that ``u`` falls on."""
        e = self.first[place]
        on = np.flatnonzero(u > self.running[e])
        while len(on):
            after = e[on] + 1
            e[on] = after
            on = on[u[on] > self.running[after]]
        return e

    def pick_one(self, place: int, u: float) -> int:
        e = int(self.first[place])
        while u > self.running[e]:
            e += 1
        return e


def _sampled(lattice: Lattice, units: np.ndarray, keys: np.ndarray, number: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Paths through all ``units``: edges end to end, and edges of each unit.  The noise is that of (key, number of the unit in its text, leaf)."""
    end = lattice.base[units] + (np.r_[lattice.base[1:], len(lattice.first)] - lattice.base)[units] - 1
    place, who, steps = lattice.base[units], np.arange(len(units)), []
    noise = mix(keys + np.uint64(leaf) * _LEAF + number.astype(np.uint64) * _PLACE)
    step = 0
    while len(who):
        e = lattice.pick(place, _uniform(noise[who] + np.uint64(step)))
        steps.append((who, e))
        place = lattice.end[e]
        on = place < end[who]
        place, who, step = place[on], who[on], step + 1
    count = np.zeros(len(units), np.int64)
    for w, _ in steps:
        count[w] += 1
    offset = slices(count)
    path = np.empty(int(offset[-1]), np.int64)
    for k, (w, e) in enumerate(steps):
        path[offset[w] + k] = e
    return path, count


def _truncated(log_mass, top: float, u):
    """A Gumbel at ``log_mass`` that is at most ``top``."""
    return log_mass - np.log(np.exp(log_mass - top) - np.log(u))


def _best_first(lattice: Lattice, key: int, fresh: list[tuple[np.ndarray, np.ndarray]], k: int):
    """The k best perturbed paths of one text, best first, and the value of the next.  ``fresh[r]`` is the r-th sample: (edges, where each unit begins)."""
    draws, noise = 0, key * int(_REST)

    def draw() -> float:
        nonlocal draws
        draws += 1
        return _uniform_of(noise + draws)

    top = -math.log(-math.log(draw()))
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    out: list[tuple[np.ndarray, float]] = []
    heap: list = []

    def add(path: np.ndarray, units: np.ndarray, value: float, since: int, mass: float) -> None:
        """Take the path, and put what it leaves aside from step ``since`` on, where the log mass is ``mass``, on the heap."""
        leaves.append((path, units))
        out.append((path, value))
        need = k + 1 - len(out)
        at = since
        while need and at < len(path):
            e = path[at : at + 512]
            log_q = lattice.log_q[e]
            after = np.cumsum(log_q)
            more = np.flatnonzero(~lattice.alone[e])
            if len(more):
                log_q = log_q[more]
                before = mass + after[more] - log_q
                rest = before + np.log(np.maximum(1.0 - np.exp(log_q), 1e-300))
                u = _uniform(np.uint64(key) * _REST + (np.uint64(len(leaves)) << np.uint64(32)) + (at + more).astype(np.uint64) * _PLACE)
                values = _truncated(rest, value, u)
                for i in np.argpartition(-values, need - 1)[:need] if len(values) > need else range(len(values)):
                    j = at + int(more[i])
                    heapq.heappush(heap, (-float(values[i]), len(leaves) - 1, j, (int(path[j]),), float(before[i])))
            at, mass = at + len(e), mass + float(after[-1])
            worst = heapq.nsmallest(need, heap)
            if len(worst) == need and mass + NOISE < -worst[-1][0]:
                break

    add(fresh[0][0], fresh[0][1], top, 0, 0.0)
    while heap and len(out) < k:
        value, leaf, j, taken, mass = heapq.heappop(heap)
        value = -value
        path, units = leaves[leaf]
        unit = int(np.searchsorted(units, j, "right")) - 1
        here = int(lattice.place[path[j]])
        low, high = int(lattice.first[here]), int(lattice.last[here])
        others = np.array([e for e in range(low, high + 1) if e not in taken])
        weights = lattice.q[others]
        pick = int(others[min(np.searchsorted(np.cumsum(weights), draw() * weights.sum()), len(others) - 1)])
        if len(others) > 1:
            left = mass + math.log(max(weights.sum() - lattice.q[pick], 1e-300))
            heapq.heappush(heap, (-float(_truncated(left, value, draw())), leaf, j, (*taken, pick), mass))
        middle = [pick]
        at = int(lattice.end[pick])
        while lattice.last[at] >= lattice.first[at]:  # to the end of the unit
            e = lattice.pick_one(at, draw())
            middle.append(e)
            at = int(lattice.end[e])
        tail, begins = fresh[len(out)]
        rest = int(begins[unit + 1]) if unit + 1 < len(begins) else len(tail)
        new = np.concatenate([path[:j], np.array(middle, np.int64), tail[rest:]])
        add(new, np.concatenate([units[: unit + 1], begins[unit + 1 :] - rest + j + len(middle)]), value, j + 1, mass + float(lattice.log_q[pick]))
    return out, (-heap[0][0] if heap else -math.inf)


def segmentations(vocabulary: Vocabulary, keys: np.ndarray, texts: list[str], k: int):
    """(row, rank, edge pieces, log probability, perturbed value, log inclusion) for every sampled segmentation of a run of texts."""
    chars, at = vocabulary.characters(texts)
    cut = np.ones(len(chars) + 1, bool)
    cut[1:-1] = ~vocabulary.together[chars[:-1], chars[1:]]
    cut[at] = True
    starts = np.flatnonzero(cut[:-1])
    ends = np.r_[starts[1:], len(chars)].astype(np.int64)
    up, down = _powers_to(len(chars))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(vocabulary.char_hash[chars] * up[: len(chars)])])
    h = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    _, example, units = np.unique(h, return_index=True, return_inverse=True)
    lattice = Lattice(vocabulary, chars, starts[example], ends[example])
    bounds = np.searchsorted(starts, at)
    per_text = np.diff(bounds)
    number = np.arange(len(starts)) - np.repeat(bounds[:-1], per_text)
    unit_keys = np.repeat(keys, per_text)
    fresh = []
    for leaf in range(k):
        path, count = _sampled(lattice, units, unit_keys, number, leaf)
        fresh.append((path, slices(count)))
    for row in range(len(texts)):
        a, b = bounds[row], bounds[row + 1]
        if a == b:
            yield row, 1, np.zeros(0, np.int32), 0.0, 0.0, 0.0
            continue
        mine = [(path[offset[a] : offset[b]], offset[a:b] - offset[a]) for path, offset in fresh]
        found, threshold = _best_first(lattice, int(keys[row]), mine, k)
        for rank, (path, value) in enumerate(found, 1):
            log_p = float(lattice.log_q[path].sum())
            x = log_p - threshold
            inclusion = x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 700.0))))
            yield row, rank, lattice.piece[path], log_p, value, inclusion


_SCHEMA = "doc_id long, rank int, ids array<int>, log_prob double, perturbed double, log_inclusion double, round_trip boolean"


def sample(docs: DataFrame, k: int = 2, seed: int = 0, model: str = MODEL, key: str = "doc_id", text: str = "text", run_size: int = RUN) -> DataFrame:
    """``run_size`` characters are worked on together: fewer take less memory and a little more time.  Up to k distinct segmentations of every row: doc_id, rank (by perturbed value), ids, log_prob, perturbed, log_inclusion, round_trip (the ids decode to the text)."""
    with open(model, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def rows(vocabulary, ids, texts):
        with np.errstate(over="ignore", divide="ignore"):
            numbers = np.array([-1 if i is None else i for i in ids], np.int64).astype(np.uint64)
            keys = mix(numbers * _LEAF + np.uint64(seed))
            found = list(segmentations(vocabulary, keys, texts, k))
        lengths = [len(f[2]) for f in found]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(np.concatenate([f[2] for f in found]).astype(np.int32)))
        back = [vocabulary.decode(f[2]) == texts[f[0]] for f in found]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[f[0]] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()), lists, *(pa.array([f[c] for f in found], pa.float64()) for c in (3, 4, 5)), pa.array(back, pa.bool_())],
            ["doc_id", "rank", "ids", "log_prob", "perturbed", "log_inclusion", "round_trip"],
        )

    def run(batches):
        vocabulary = Vocabulary(sent.value)
        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py() or ""
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= run_size:
                    yield rows(vocabulary, ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield rows(vocabulary, ids, texts)

    return keyed(docs, key, text).mapInArrow(released(run), _SCHEMA)


def decode(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``rows`` with the column ``decoded``: the text that the pieces of ``ids`` spell (null for null); underscores are added where ``rows`` has such a column."""
    from pyspark.sql import types as T

    with open(model, "rb") as f:
        sent = rows.sparkSession.sparkContext.broadcast(f.read())
    at = rows.columns.index(ids)
    name = free_name(rows.columns, "decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])

    def run(batches):
        vocabulary = Vocabulary(sent.value)
        for b in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in (v.values.to_numpy() if v.is_valid else None for v in b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, name])

    return rows.mapInArrow(released(run), schema)
