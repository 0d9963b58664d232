"""Evaluation texts leaking into training text: latent semantic retrieval, then alignment and answer checks.

1. Every document is normalised to words once; words of the items become numbers, all others -1. Document frequencies are
   counted over all documents. Weights are TF-IDF with the rarity scaled to [1, 2], words outside of the items weigh 2: so a
   stretch keeps a high cosine with its item whatever words stand in place of the replaced ones.
2. A distributed randomised SVD of the TF-IDF passage matrix A (passages of all documents and of the items, over the words
   of the items) gives latent word vectors. A'A is summed over all passages in one pass, as the few words of a passage that
   are item words make few products; the range finder multiplies the rows of A'A where they lie.
3. Windows of every document are compared with the items' windows by cosine in the latent space. What the space leaves out
   is bounded by the product of the two residual norms, so latent product plus residual product is never below the cosine of
   the full vectors: the search loses no pair of windows with at least that cosine, whatever the rank. Windows with fewer item
   words than any stretch has are left out first.
4. Candidates are aligned with the item by a longest common subsequence with few gaps. ``stretch``: a stretch of the wanted
   length agrees in the wanted share of its words. ``paraphrase``: fewer words agree, but the answer stands in the passage.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.runtime import materialise, pick

#: A tag of any length: a letter, a slash, a mark or a comment must follow, so that "a < b" stays text.
_TAG = regex.compile(r"<(?:[/!?]?[A-Za-z]|!--)[^<>]*>")
_BREAK = regex.compile(r"(?<=\w)[-‐]\s*\n\s*(?=[a-zß-ÿ])")
_MARKS = regex.compile(r"[\p{Mn}\p{Cf}]+")
_APOSTROPHE = regex.compile("['’ʼ]")
_WORD = regex.compile(r"[^\W_]+")
_PLAIN = bytes(ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)) + bytes(range(128, 256))


@dataclass(frozen=True)
class Settings:
    """``stretch`` words of an item must be found, ``agree`` of them in place; a paraphrase needs ``loose`` of them and the
    answer. The rest tunes retrieval and memory.

    ``inside``: of ``window`` words taken every ``step``, some window holds so many words of a stretch whose words stand within
    20 of the document. ``cosine``: the gate of full vectors; planted stretches with a fifth of their words replaced, changed
    or left out have 0.54 or more. The rank is ``rank``, or a third of the vocabulary if that is more. ``block`` items are
    searched at a time; each block is one pass, whose vocabulary and windows are shipped to the workers: their size is
    bounded by the block, not by the data.
    """

    stretch: int = 15
    agree: float = 0.8
    loose: float = 0.6
    window: int = 16
    step: int = 4
    item_step: int = 2
    inside: int = 8
    rank: int = 256
    oversample: int = 16
    iterations: int = 2
    cosine: float = 0.40
    block: int = 500
    batch_words: int = 200_000
    seed: int = 7


def plain(text: str | None) -> str:
    """A text's lower-case words with blanks between, without markup, accents, soft hyphens, punctuation and apostrophes."""
    if not text:
        return ""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    if "-" in text or "‐" in text:
        text = _BREAK.sub("", text)
    if text.isascii():
        return text.encode().translate(_PLAIN, b"'").decode()
    return " ".join(_WORD.findall(_APOSTROPHE.sub("", text).lower()))


def words(text: str | None) -> list[str]:
    """The words of :func:`plain`."""
    return plain(text).split()


@dataclass
class Items:
    """A block of items as word numbers, with its vocabulary, that of the answers included."""

    ids: list[int]
    answers: list[list[str]]
    texts: list[np.ndarray]
    vocabulary: dict[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: list, longest: int = 400) -> Items:
        """Texts of more than ``longest`` words are laid out as overlapping parts under the same id.

        Every part of a stretch of up to 60 words lies whole in some part, and a longer stretch has such a part that agrees at
        least as well, so nothing is lost.
        """
        out = cls([], [], [], {})
        for r in rows:
            ids = np.array([out.vocabulary.setdefault(w, len(out.vocabulary)) for w in words(r["text"])], dtype=np.int32)
            for w in words(r["answer"]):
                out.vocabulary.setdefault(w, len(out.vocabulary))
            for k in range(0, max(1, len(ids) - 60), longest - 60):
                out.ids.append(r["item_id"])
                out.answers.append(words(r["answer"]))
                out.texts.append(ids[k : k + longest])
        return out


def numbered(documents: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(doc_id, ids): each document's words as numbers of the vocabulary, -1 for others; documents without a word of it
    are left out, as they share nothing with any item."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(list(vocabulary), pa.string())
        for b in batches:
            parts = pc.utf8_split_whitespace(pa.array([plain(t).strip() or "-" for t in b.column("text").to_pylist()], pa.string()))
            ids = pc.fill_null(pc.index_in(parts.flatten(), value_set=known), -1)
            lists = pa.ListArray.from_arrays(parts.offsets, ids)
            some = np.zeros(len(lists), dtype=bool)
            some[np.asarray(pc.list_parent_indices(lists))[np.asarray(ids) >= 0]] = True
            out = pa.RecordBatch.from_arrays([b.column("doc_id"), lists], ["doc_id", "ids"])
            yield out.filter(pa.array(some))

    return documents.select("doc_id", "text").where("text is not null and doc_id is not null").mapInArrow(number, "doc_id long, ids array<int>")


def weights_of(docs: DataFrame, n_docs: int, size: int) -> tuple[np.ndarray, float]:
    """The weight of each vocabulary word, 1 plus its scaled inverse document frequency over all documents, and that of a
    word outside, the largest there is."""
    counts = docs.select(F.explode(F.array_distinct("ids")).alias("w")).where("w >= 0").groupBy("w").count().collect()  # at most one row per item word
    df = np.zeros(size)
    for r in counts:
        df[r["w"]] = r["count"]
    return (1 + np.log((n_docs + 2) / (df + 1)) / np.log(n_docs + 2)).astype(np.float32), 2.0


def _entries(ids: np.ndarray, weights: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, word, value) of the unit TF-IDF rows of consecutive passages of ``width`` words, by passage."""
    size = len(weights)
    keep = np.flatnonzero(ids >= 0)
    code, tf = np.unique(keep // width * size + ids[keep], return_counts=True)
    at, word = code // size, code % size
    value = tf * weights[word].astype(np.float64)
    norm = np.sqrt(np.bincount(at, value**2))
    return at, word, value / norm[at]


def _products(ids: np.ndarray, weights: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A'A of the passages of ``ids``, sparse: codes (row times size plus column) and sums."""
    at, word, value = _entries(ids, weights, width)
    first = np.searchsorted(at, at, side="left")
    n = np.searchsorted(at, at, side="right") - first
    left = np.repeat(np.arange(len(at)), n)
    right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    code, where = np.unique(word[left] * len(weights) + word[right], return_inverse=True)
    return code, np.bincount(where, value[left] * value[right], len(code))


def gram(docs: DataFrame, weights: np.ndarray, width: int) -> DataFrame:
    """(w, v, g): A'A over the passages of all documents. Products are summed per batch before the shuffle; a row of the
    result has at most as many entries as the items have words."""
    size = len(weights)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            # Passages don't cross documents: each is padded to whole passages with words outside of the vocabulary.
            flat = np.concatenate([y for x in b.ids for y in (x, np.full(-len(x) % width, -1, dtype=np.int32))])
            code, g = _products(flat, weights, width)
            yield pd.DataFrame({"w": code // size, "v": code % size, "g": g})

    return docs.select("ids").mapInPandas(part, "w int, v int, g double").groupBy("w", "v").agg(F.sum("g").alias("g"))


def _times(products: DataFrame, q: np.ndarray) -> np.ndarray:
    """(A'A) q: the entries of a row of A'A lie in one partition, so every task makes whole rows of the product."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row, at = np.unique(b.w.to_numpy(), return_inverse=True)
            for k in range(0, len(row), 512):
                here = (at >= k) & (at < k + 512)
                dense = np.zeros((min(512, len(row) - k), len(q)), dtype=np.float32)
                np.add.at(dense, (at[here] - k, b.v.to_numpy()[here]), b.g.to_numpy()[here])
                yield pd.DataFrame({"w": row[k : k + 512], "row": list(dense @ q)})

    out = np.zeros(q.shape)
    for r in products.mapInPandas(part, "w int, row array<float>").collect():  # vocabulary x rank numbers, bounded by the block of items
        out[r["w"]] += r["row"]
    return out


def latent_words(docs: DataFrame, items: Items, weights: np.ndarray, s: Settings) -> np.ndarray:
    """Latent word vectors (vocabulary x rank): right singular vectors of the passage matrix by a randomised range finder.

    The items' own passages are part of the matrix; their rows are scaled to four times the norm of the corpus, as the items
    are what has to be told apart.
    """
    size = len(weights)
    rank = min(max(s.rank, -(-size // 3)), size)
    mine = np.zeros((size, size)) if size <= 4096 else None
    own = [_products(t, weights, s.window) for t in items.texts if len(t)]
    products = materialise(gram(docs, weights, s.window).repartition("w").sortWithinPartitions("w"), "gram")

    def own_times(q: np.ndarray) -> np.ndarray:
        out = np.zeros(q.shape)
        for code, g in own:
            np.add.at(out, code // size, g[:, None] * q[code % size])
        return out

    if mine is not None:
        for code, g in own:
            mine[code // size, code % size] += g
    q = np.linalg.qr(np.random.default_rng(s.seed).standard_normal((size, min(size, rank + s.oversample))))[0]
    value = None
    for turn in range(s.iterations + 1):
        corpus = _times(products, q.astype(np.float32))
        ours = mine @ q if mine is not None else own_times(q)
        value = corpus + ours * max(4 * np.linalg.norm(corpus) / max(np.linalg.norm(ours), 1e-12), 1.0)
        if turn < s.iterations:
            q = np.linalg.qr(value)[0]
    # q' (A'A) q is small: its eigenvectors turn the range into singular directions.
    small = q.T @ value
    _, vectors = np.linalg.eigh((small + small.T) / 2)
    return (q @ vectors[:, ::-1][:, :rank]).astype(np.float32)


class Bank:
    """Windows of words as latent unit vectors, with what the latent space leaves of each as one more coordinate."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, outside: float, vectors: np.ndarray) -> None:
        """``ids``: a row per window, -1 for words outside of the vocabulary, -2 for none."""
        self.ids = ids
        self.square = np.where(ids >= 0, weights[ids].astype(np.float32) ** 2, 0)
        own = np.einsum("ij,ij->i", (ids[:, :, None] == ids[:, None, :]).sum(axis=2, dtype=np.float32), self.square)
        self.norm = np.sqrt(own + (ids == -1).sum(axis=1) * np.float32(outside) ** 2) + np.float32(1e-9)
        embed = np.vstack([vectors * weights[:, None], np.zeros((2, vectors.shape[1]), np.float32)])
        latent = np.zeros((len(ids), vectors.shape[1] + 1), dtype=np.float32)
        for j in range(ids.shape[1]):
            latent[:, :-1] += embed[ids[:, j]]
        rest = own - np.einsum("ij,ij->i", latent, latent)
        latent[:, -1] = np.sqrt(np.maximum(rest, 0))
        self.latent = latent / self.norm[:, None]

    def near(self, other: Bank, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mine, theirs, cosine) of all pairs of windows with at least that cosine of the full vectors."""
        found = []
        rows = max(16, 8_000_000 // max(1, len(other.ids)))
        for k in range(0, len(self.ids), rows):
            x, y = np.nonzero(self.latent[k : k + rows] @ other.latent.T >= cosine - 1e-4)
            for c in range(0, len(x), 50_000):
                a, b = x[c : c + 50_000] + k, y[c : c + 50_000]
                alike = (self.ids[a][:, :, None] == other.ids[b][:, None, :]).sum(axis=2, dtype=np.float32)
                cos = np.einsum("ij,ij->i", alike, self.square[a]) / (self.norm[a] * other.norm[b])
                keep = cos >= cosine - 1e-6
                found.append((a[keep], b[keep], cos[keep]))
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        return tuple(np.concatenate(z) for z in zip(*found))


def _windows(flat: np.ndarray, bounds: np.ndarray, width: int, step: int, inside: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, ids) of the windows of texts laid end to end that hold at least ``inside`` known words."""
    length = np.diff(bounds)
    n = np.where(length > 0, 1 + np.maximum(0, -(-(length - width) // step)), 0)
    owner = np.repeat(np.arange(len(length)), n)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    start = bounds[owner] + np.minimum(turn * step, np.maximum(0, length[owner] - width))
    stop = np.minimum(start + width, bounds[owner + 1])
    total = np.concatenate([[0], np.cumsum(flat >= 0)])
    keep = total[stop] - total[start] >= inside
    owner, start, stop = owner[keep], start[keep], stop[keep]
    at = start[:, None] + np.arange(width)
    ids = np.where(at < stop[:, None], flat[np.minimum(at, max(0, len(flat) - 1))], -2) if len(start) else np.zeros((0, width), np.int32)
    return owner, start, ids


def align(pairs: list[tuple[np.ndarray, np.ndarray]], s: Settings) -> list[np.ndarray | None]:
    """For pairs (item, piece of a document): the place of each item word in the piece or -1, None for pairs without a stretch.

    A local alignment (match 1, replaced or skipped word -0.5) gives the longest common subsequence with few gaps. Pairs of
    like size are aligned together, a row of all their tables at a time.
    """
    out: list[np.ndarray | None] = [None] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda k: (len(pairs[k][0]), len(pairs[k][1])))
    k = 0
    while k < len(order):
        n = m = 0
        upto = k
        while upto < len(order):
            n1, m1 = max(n, len(pairs[order[upto]][0])), max(m, len(pairs[order[upto]][1]))
            if upto > k and (upto - k + 1) * (n1 + 1) * (m1 + 1) > 4_000_000:
                break
            n, m, upto = n1, m1, upto + 1
        chunk = order[k:upto]
        item = np.full((len(chunk), n), -3, dtype=np.int32)
        doc = np.full((len(chunk), m), -4, dtype=np.int32)
        for r, c in enumerate(chunk):
            item[r, : len(pairs[c][0])], doc[r, : len(pairs[c][1])] = pairs[c]
        for r, place in _align_table(item, doc, s):
            out[chunk[r]] = place[: len(pairs[chunk[r]][0])]
        k = upto
    return out


def least_score(s: Settings) -> float:
    """What the alignment of a loose stretch scores at least: its words in place, less half a word for each other one."""
    lost = s.stretch - int(np.ceil(s.loose * s.stretch - 1e-9))
    return s.stretch - 1.5 * lost - 0.5 * (int(1.4 * s.stretch + 3) - s.stretch)


def _align_table(item: np.ndarray, doc: np.ndarray, s: Settings) -> Iterator[tuple[int, np.ndarray]]:
    n, m = item.shape[1], doc.shape[1]
    score = np.zeros((len(item), n + 1, m + 1), dtype=np.float32)
    ramp = 0.5 * np.arange(m + 1, dtype=np.float32)
    for i in range(1, n + 1):
        row = np.maximum(score[:, i - 1, :-1] + np.where(item[:, i - 1, None] == doc, np.float32(1.0), np.float32(-0.5)), score[:, i - 1, 1:] - np.float32(0.5))
        np.maximum(row, 0, out=score[:, i, 1:])
        # A word of the document that is passed over costs 0.5: a running maximum does the whole row.
        np.maximum.accumulate(score[:, i] + ramp, axis=1, out=score[:, i])
        score[:, i] -= ramp
    flat = score.reshape(len(item), -1)
    top = flat.argmax(axis=1)
    rows = np.flatnonzero(flat[np.arange(len(item)), top] >= max(least_score(s), s.stretch * s.loose / 2) - 1e-6)
    i, j = top[rows] // (m + 1), top[rows] % (m + 1)
    end_i, end_j = i.copy(), j.copy()
    place = np.full((len(rows), n), -1)
    live = np.arange(len(rows))
    while True:
        live = live[(i[live] > 0) & (j[live] > 0)]
        live = live[score[rows[live], i[live], j[live]] > 0]
        if not len(live):
            break
        r, a, b = rows[live], i[live], j[live]
        here = score[r, a, b]
        over = here - score[r, a - 1, b - 1]
        hit = (item[r, a - 1] == doc[r, b - 1]) & (np.abs(over - 1.0) < 1e-4)
        swap = ~hit & (np.abs(over + 0.5) < 1e-4)
        up = ~hit & ~swap & (np.abs(here - score[r, a - 1, b] + 0.5) < 1e-4)
        place[live[hit], a[hit] - 1] = b[hit] - 1
        i[live] -= hit | swap | up
        j[live] -= ~up
    w = s.stretch // 2
    for k, r in enumerate(rows):
        own = place[k]
        if not _stretch(own, s.agree, s)[0]:
            # An end such as one word in place before three replaced ones is worth nothing to the score, yet belongs to a stretch.
            equal = lambda x, y: item[r, x[0] : x[1], None] == doc[r, None, y[0] : y[1]]  # noqa: B023, E731
            _fill(own, equal((max(0, i[k] - w), i[k]), (max(0, j[k] - 2 * w), j[k])), max(0, i[k] - w), max(0, j[k] - 2 * w))
            a, b = min(end_i[k] + w, n), min(end_j[k] + 2 * w, m)
            _fill(own, equal((end_i[k], a), (end_j[k], b))[::-1, ::-1], a - 1, b - 1, True)
        yield int(r), own


def _fill(place: np.ndarray, equal: np.ndarray, i: int, j: int, backwards: bool = False) -> None:
    """Puts a longest common subsequence of a small rectangle that starts at (i, j) into ``place``; backwards, it ends there."""
    rows, columns = equal.shape
    longest = np.zeros((rows + 1, columns + 1), dtype=int)
    for a in range(rows):
        for b in range(columns):
            longest[a + 1, b + 1] = longest[a, b] + 1 if equal[a, b] else max(longest[a, b + 1], longest[a + 1, b])
    a, b = rows, columns
    while a and b:
        if equal[a - 1, b - 1]:
            a, b = a - 1, b - 1
            if backwards:
                place[i - a] = j - b
            else:
                place[i + a] = j + b
        elif longest[a - 1, b] >= longest[a, b - 1]:
            a -= 1
        else:
            b -= 1


def _stretch(place: np.ndarray, agree: float, s: Settings) -> tuple[int, float]:
    """The longest stretch of an item of which enough words have a place in the document, and their share; (0, 0.0) without one.

    The part of the document may hardly be longer than the stretch.
    """
    n = len(place)
    if (place >= 0).sum() < agree * s.stretch - 1e-9:
        return 0, 0.0
    hit = np.concatenate([[0], np.cumsum(place >= 0)])
    a, b = np.triu_indices(n + 1, s.stretch)
    share = (hit[b] - hit[a]) / (b - a)
    fine = share >= agree - 1e-9
    a, b, share = a[fine], b[fine], share[fine]
    for k in np.argsort(a - b, kind="stable"):
        inside = place[a[k] : b[k]]
        inside = inside[inside >= 0]
        if inside[-1] - inside[0] + 1 <= 1.4 * (b[k] - a[k]) + 3:
            return int(b[k] - a[k]), float(share[k])
    return 0, 0.0


def search(docs: DataFrame, items: Items, weights: np.ndarray, outside: float, vectors: np.ndarray, s: Settings) -> DataFrame:
    """(doc_id, item_id, kind, stretch, share, answer_found) of the candidates that pass the alignment."""
    texts = [t if len(t) >= s.stretch else t[:0] for t in items.texts]
    vocabulary = items.vocabulary
    answers = [[vocabulary.get(w, -2) for w in a] for a in items.answers]
    owner, _, ids = _windows(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), s.window, s.item_step)
    margin = int(1.4 * s.stretch + 3) + 1
    shape = "doc_id long, item_id long, kind string, stretch int, share double, answer_found boolean"

    def found(names: list, bodies: list[np.ndarray], bank: Bank) -> list[tuple]:
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in bodies])])
        doc, start, got = _windows(np.concatenate(bodies), bounds, s.window, s.step, s.inside)
        if not len(doc):
            return []
        x, y, _ = Bank(got, weights, outside, vectors).near(bank, s.cosine)
        code = np.unique((doc[x] * len(texts) + owner[y]) * (int(bounds[-1]) + 1) + start[x] - bounds[doc[x]])
        pair, at = code // (int(bounds[-1]) + 1), code % (int(bounds[-1]) + 1)
        cut = np.flatnonzero(np.diff(pair)) + 1
        which, pieces = [], []
        for p, places in zip(pair[np.concatenate([[0], cut])] if len(pair) else [], np.split(at, cut)):
            d, i = int(p) // len(texts), int(p) % len(texts)
            for piece in _runs(bodies[d], texts[i], places, s.window, margin):
                which.append((d, i))
                pieces.append((texts[i], piece))
        best: dict[tuple, tuple] = {}
        for (d, i), (_, piece), place in zip(which, pieces, align(pieces, s)):
            if place is None:
                continue
            answered = _contains(piece, answers[i])
            length, share = _stretch(place, s.agree, s)
            kind = "stretch"
            if not length and answered:
                kind, (length, share) = "paraphrase", _stretch(place, s.loose, s)
            key = (names[d], items.ids[i])
            if length and (kind == "stretch", length) > (best.get(key, ("",))[0] == "stretch", best.get(key, ("", 0))[1]):
                best[key] = (kind, length, share, answered)
        return [(*k, *v) for k, v in best.items()]

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bank = Bank(ids, weights, outside, vectors)
        for b in batches:
            out, k = [], 0
            bodies, names = list(b.ids), list(b.doc_id)
            while k < len(bodies):
                upto, n = k, 0
                while upto < len(bodies) and (upto == k or n + len(bodies[upto]) <= s.batch_words):
                    n += len(bodies[upto])
                    upto += 1
                out += found(names[k:upto], bodies[k:upto], bank)
                k = upto
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "kind", "stretch", "share", "answer_found"])

    if not len(ids):
        return docs.sparkSession.createDataFrame([], shape)
    return docs.mapInPandas(part, shape)


def _runs(doc: np.ndarray, item: np.ndarray, places: np.ndarray, reach: int, margin: int) -> list[np.ndarray]:
    """The document from ``margin`` words before each place to ``margin`` after its ``reach``; near ones are one run.

    A long run is cut into overlapping pieces, each wide enough for any stretch of the item.
    """
    out = []
    width = 2 * len(item) + 60
    for run in np.split(places, np.flatnonzero(np.diff(places) > reach) + 1):
        first, last = max(0, int(run[0]) - margin), min(len(doc), int(run[-1]) + reach + margin)
        out += [doc[k : min(k + 2 * width, last)] for k in range(first, max(first + 1, last - width), width)]
    return out


def _contains(piece: np.ndarray, answer: list[int]) -> bool:
    """Whether the words of the answer stand in a row in the piece."""
    k = len(answer)
    return bool(k) and any((piece[i : i + k] == answer).all() for i in range(len(piece) - k + 1))


def leaks(documents: DataFrame, items: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, kind, stretch, share, answer_found): documents that contain a stretch of an item's text, or its answer
    amid a passage that agrees loosely with it (``kind`` paraphrase).

    Null and empty texts, and items of fewer than ``stretch`` words, have no leak. A document with several items has one
    row for each. Copies of a document are reported each. Items are read in blocks of ``block`` by id, each block one
    search over all documents; nothing of the documents is gathered on the driver.
    """
    documents, items = pick(documents, "doc_id", "text"), pick(items, "item_id", "text", "answer")
    count = items.count()
    n_docs = documents.count()
    kept = items.where("text is not null and item_id is not null").select("item_id", "text", F.coalesce("answer", F.lit("")).alias("answer"))
    blocks = max(1, -(-count // s.block))
    found = None
    if blocks > 1:  # words are cut once, not once per block
        plain_text = F.pandas_udf(lambda t: t.map(plain), "string")
        documents = materialise(documents.select("doc_id", plain_text("text").alias("text")), "plain")
    for k in range(blocks):
        mine = kept if blocks == 1 else kept.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        block = Items.of(mine.orderBy("item_id").collect())
        if not block.vocabulary:
            continue
        docs = materialise(numbered(documents, block.vocabulary), "numbered")
        weights, outside = weights_of(docs, n_docs, len(block.vocabulary))
        vectors = latent_words(docs, block, weights, s)
        part = search(docs, block, weights, outside, vectors, s)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return documents.sparkSession.createDataFrame([], "doc_id long, item_id long, kind string, stretch int, share double, answer_found boolean")
    return found
