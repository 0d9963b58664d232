"""Abusive, hateful or sexual content: lexicon and style features, gradient-boosted trees, isotonic calibration.

Each passage (sentence or line) of a document gives dense features, and a document scores as its worst passage, as one is
enough to make it offensive. Judgements are of documents, so the trees are boosted twice: first with the passage of each
offensive document that has most evidence, then with the one that the first trees score highest. The judged documents are
split into halves and each half has a model of its own, word weights included; scores are calibrated on the predictions for
the other half. A judged document is scored by the model that has not seen it, all others by the mean of both.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions import text as T
from panelloom.runtime import materialise, pick

# Lexicons of common knowledge, without accents, in English, Spanish, French and German. What the project's own documents say
# beyond them is learned from the judgements, never listed here.
LEXICON = {
    "insult": """idiot idiots moron morons imbecile imbeciles cretin retard retards retarded stupid dumb brainless worthless pathetic loser losers
        scum scumbag garbage filth filthy pig pigs clown freak freaks bastard bastards bitch bitches asshole assholes arsehole jerk fool useless
        ugly fat liar liars coward cowards trash twat prick wanker bugger git cow rat
        idiota idiotas imbecil estupido estupida estupidos inutil asqueroso asquerosa cerdo cerda basura cabron pendejo gilipollas tonto tonta payaso zorra
        connard connards connasse abruti salaud salope ordure encule batard debile bouffon cretin imbecile
        arschloch arschlocher trottel wichser hurensohn schlampe missgeburt dreckskerl abschaum depp dummkopf versager idioten""",
    "profane": """fuck fucks fucking fucked fucker fuckers motherfucker shit shits shitty bullshit piss cunt cunts dickhead puta putas puto mierda joder carajo
        putain merde foutre gueule bordel pute putes scheisse verdammt scheiss fresse verpiss fotze""",
    "mild": "damn damned crap hell bloody mess heck darn",
    "violence": """kill kills killed killing murder beat beaten beating choke strangle stab stabbed shoot shot burn hang hanged drown rape smash break
        cut hit hurt knife gun throat punch kick slap bleed
        matar matare romper rompo golpear quemar tuer frapper casser etrangler bruler
        umbringen toten schlagen brechen abstechen verbrennen""",
    "harm": "die dies dead death rot suicide grave morir muerte muere mueras muerete mourir creve crever mort sterben stirb stirbst verrecke tot",
    "dehuman": """vermin subhuman subhumans rats animals parasites parasite cockroaches disease plague savages monkeys apes scum
        ratas ratones animales plaga parasitos sabandijas vermine parasites cafards nuisibles animaux betes ungeziefer untermenschen parasiten ratten tiere""",
    "sexual": """cock cocks dick dicks pussy tits boobs cum cumming moaning naked nude nudes horny slut sluts whore whores suck sucked sucking
        lick licked licking erection orgasm blowjob porn porno ass arse anal
        follar follarte polla desnuda desnudo desnudas tetas chupar mamada coger baiser bite nue nus seins sucer chatte
        ficken nackt nackte schwanz titten blasen muschi geil""",
    "bodily": "sex bed body breasts breast penis vagina sexual sexo sexe sexuell",
    "official": """conduct policy policies ban banned report reported record recorded form column education screening clinic health survey counselling
        prevention assault harassment statistics census course safety code threats explicit gender count rate process training law court study
        research data table student students staff university college""",
    "group": """foreigners immigrants migrants refugees cripples disabled women men jews muslims christians blacks whites gays lesbians gypsies natives
        extranjeros mujeres inmigrantes gitanos negros judios etrangers femmes immigres juifs arabes noirs auslander frauen fluchtlinge juden""",
    "all_of": "all those these every each never los las todos todas tous toutes les alle diese",
    "second": "you your yours yourself yourselves u ur tu te ti eres tus usted vosotros toi ta ton tes vous votre du dich dir dein deine deinen ihr euch",
    "self": "i my me myself mine we our yo mi je mon ma ich mein meine",
}
# Frames of speech that threaten, wish harm, command or debase, whatever the words in them.
FRAMES = {
    "threat": r"\b(?:i|we)(?: will| ll| am going to| are going to| should) (?:\w+ ){0,4}(?:you|your|yours|u)\b|\b(?:you will|you ll|you are going to) (?:\w+ ){0,2}(?:regret|pay|die|suffer|bleed|be sorry)\b|\bich werde? (?:\w+ )?d(?:ich|ir)\b|\bje vais te\b|\bte voy a\b",
    "wish": r"\bhope (?:you|he|she|they|your)\b|\bojala (?:te|que)\b|\bj ?espere que tu\b|\bich hoffe (?:du|ihr)\b|\bdrop dead\b|\b(?:kill|hang|hurt) yourself\b|\bgo (?:and )?(?:die|rot|hang|kill)\b|\bbetter off dead\b",
    "command": r"\bshut (?:up|your|the fuck)\b|\bgo fuck\b|\bfuck (?:you|off)\b|\bget lost\b|\bpiss off\b|\bcallate\b|\bvete a\b|\bva te\b|\bferme (?:la|ta)\b|\bhalt (?:die|dein)\b|\bverpiss dich\b",
    "debase": r"\b(?:you|he|she|they|u) (?:are|re|is|r) (?:all |just |such |nothing but |only )?(?:an? )?(?:\w+ )?(?:$BAD)\b|\b(?:eres|son|sois|es) (?:un |una |unos |todos )?(?:$BAD)\b|\b(?:tu es|vous etes|ils sont|sont) (?:un |une |des |tous )?(?:$BAD)\b|\b(?:du bist|ihr seid|sie sind|sind) (?:ein |eine |alle )?(?:$BAD)\b",
    "address": r"\byou (?:\w+ )?(?:$BAD)\b|\bdu (?:\w+ )?(?:$BAD)\b|\bespece d ?e? ?(?:$BAD)\b|\b(?:piece|sack) of (?:shit|garbage|trash|filth|crap)\b",
}
_LEX_OF: dict[str, list[int]] = {}
for _k, _words in enumerate(LEXICON.values()):
    for _w in _words.split():
        if _k not in _LEX_OF.setdefault(_w, []):
            _LEX_OF[_w].append(_k)
_HARD = {w for k in ("insult", "profane", "dehuman", "sexual") for w in LEXICON[k].split() if len(w) > 2}
_BAD = "|".join(sorted({w for k in ("insult", "profane", "dehuman") for w in LEXICON[k].split()}))
_BY_LENGTH: dict[tuple[int, str], list[str]] = {}
for _w in sorted(_HARD):
    _BY_LENGTH.setdefault((len(_w), _w[0]), []).append(_w)
_FRAME = [re.compile(p.replace("$BAD", _BAD)) for p in FRAMES.values()]
CATEGORIES = [*LEXICON]
_SIGNAL = {CATEGORIES.index(c) for c in ("insult", "profane", "violence", "harm", "dehuman", "sexual", "bodily")}
#: Names of the dense features, in order; the last two come from the word weights.
FEATURES = [
    *[f"lex_{c}" for c in CATEGORIES], *[f"frame_{p}" for p in FRAMES],
    "second_near_insult", "second_near_violence", "group_near_dehuman", "insult_not_self", "hard_hidden", "hidden", "capitals", "exclamations",
    "density_hard", "evidence", "learned_max", "learned_sum",
]

#: Features that can only speak for an offence: a tree may not let a larger value lower the score.
RISING = [
    i for i, f in enumerate(FEATURES)
    if f not in ("lex_mild", "lex_official", "lex_group", "lex_all_of", "lex_second", "lex_self", "lex_bodily", "hidden", "capitals", "exclamations", "density_hard")
]

#: A tag of any length; see the leak search.
_TAG = re.compile(r"<(?:[/!?]?[A-Za-z]|!--)[^<>]*>")
_SPLIT = re.compile(r"(?<=[.!?])\s+|\n+")
_SPACED = re.compile(r"(?<![\w@$*])[^\W_](?:[ .\-_*][^\W_]){2,}(?![\w@$*])")
_DOTTED = re.compile(r"(?<![\w.])[^\W_](?:\.[^\W_]){1,}[^\W_]*(?:\.[^\W_]+)*")
_TOKEN = re.compile(r"[^\W_][\w@$*!]*[\w@$*]|[^\W_]|[@$][\w@$*]+")
_LEET = str.maketrans("@$013457!", "asoieasti")
_RUN = re.compile(r"(.)\1{2,}")
_MARKS = regex.compile(r"[\p{Mn}\p{Cf}]+")


def passages(text: str) -> list[str]:
    """Sentences and lines of a text, without markup and accents; a long passage stays whole."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text.replace("ß", "ss")))
    return [p for p in _SPLIT.split(text) if p and not p.isspace()]


def tokens(passage: str) -> tuple[list[str], int, int]:
    """Plain lower-case words of a passage, how many were hidden (spaced, dotted, masked, digits for letters), and how many
    of the hidden ones are hard words of the lexicon."""
    hidden = hard = 0
    low = passage.lower()
    if _SPACED.search(low):
        low = _SPACED.sub(lambda m: " " + re.sub(r"[ .\-_*]", "", m.group()) + " ", low)
        hidden += 1
    if "." in low:
        joined = _DOTTED.sub(lambda m: m.group().replace(".", ""), low)
        hidden += joined != low
        low = joined
    out = []
    for raw in _TOKEN.findall(low):
        w = raw
        if not w.isalpha() and not w.isdigit():
            if "*" in w:
                shape = re.compile(w.replace("*", "[a-z]").translate(_LEET).replace("$", "s") if w.count("*") < len(w) else "x^")
                fits = [x for x in _BY_LENGTH.get((len(w), w[0]), ()) if shape.fullmatch(x)]
                hidden += 1
                if fits:
                    hard += 1
                    w = fits[0]
            else:
                plain = w.translate(_LEET)
                if plain != w and plain.isalpha():
                    if plain in _LEX_OF:
                        hidden += 1
                        hard += plain in _HARD
                    w = plain
        if len(w) > 3:
            w = _RUN.sub(r"\1", w)
        out.append(w)
    return out, hidden, hard


def grams(words: list[str]) -> list[str]:
    """Words and pairs of words; numbers are left out."""
    kept = [w for w in words if not w.isdigit()]
    return kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])]


def _nearest(a: list[int], b: list[int]) -> float:
    """1 for the same place, falling with the least distance between two ascending lists of places; 0 if either is empty."""
    if not a or not b:
        return 0.0
    i = j = 0
    least = abs(a[0] - b[0])
    while i < len(a) and j < len(b):
        least = min(least, abs(a[i] - b[j]))
        if a[i] < b[j]:
            i += 1
        else:
            j += 1
    return 1.0 / (1 + least / 4)


def passage_features(passage: str) -> tuple[list[float], list[str]]:
    """The dense features of one passage without those of the word weights, and its grams."""
    words, hidden, hard = tokens(passage)
    own = grams(words)
    at: list[list[int]] = [[] for _ in CATEGORIES]
    signal = hard > 0
    for i, w in enumerate(words):
        for k in _LEX_OF.get(w, ()):
            at[k].append(i)
            signal = signal or k in _SIGNAL
    letters = sum(map(str.isalpha, passage))
    capitals = sum(map(str.isupper, passage)) / (letters + 8)
    style = [float(hard), float(hidden), capitals, passage.count("!") / len(passage)]
    if signal or at[CATEGORIES.index("second")]:
        flat = " ".join(words)
        frames = [float(len(p.findall(flat))) for p in _FRAME]
    else:
        frames = [0.0] * len(_FRAME)
    c = dict(zip(CATEGORIES, at))
    bad = sorted([*c["insult"], *c["profane"]])
    near = _nearest(c["second"], bad)
    strong = len(bad) + len(c["sexual"]) + len(c["dehuman"])
    evidence = 2.0 * sum(frames[1:]) + frames[0] * (1 + len(c["violence"])) + len(c["profane"]) + 0.7 * len(c["insult"]) + len(c["sexual"]) + 0.5 * len(c["dehuman"]) + hard + near
    return [
        *map(float, map(len, at)), *frames, near, _nearest(c["second"], sorted([*c["violence"], *c["harm"]])), _nearest(sorted([*c["group"], *c["all_of"]]), c["dehuman"]),
        float(bool(bad) and not c["self"]), *style, strong / max(1, len(words)), evidence,
    ], own


def learned_features(own: list[str], weights: dict[str, float]) -> list[float]:
    """The largest word weight of a passage and their sum."""
    found = [weights[g] for g in own if g in weights]
    return [max(found, default=0.0), sum(found)]


class Scorer:
    """Passage features of documents; a passage that stands in several documents of a task is worked out once."""

    def __init__(self, weights: list[dict[str, float]], keep: int = 100_000) -> None:
        self.weights, self.keep = weights, keep
        self.known: dict[str, tuple] = {}

    def document(self, text: str | None) -> tuple[np.ndarray, list[np.ndarray]]:
        """The different passages of a document: base features, and learned features per word-weight table. Null and empty
        texts have one row of zeros."""
        base, learned = [], [[] for _ in self.weights]
        for p in dict.fromkeys(passages(text or "")):
            got = self.known.get(p)
            if got is None:
                row, own = passage_features(p)
                got = (row, [learned_features(own, w) for w in self.weights])
                if len(self.known) >= self.keep:
                    self.known.clear()
                self.known[p] = got
            base.append(got[0])
            for k, x in enumerate(got[1]):
                learned[k].append(x)
        if not base:
            base, learned = [[0.0] * (len(FEATURES) - 2)], [[[0.0, 0.0]] for _ in self.weights]
        return np.array(base, dtype=np.float32), [np.array(x, dtype=np.float32) for x in learned]


# --- trees and calibration


@dataclass
class Trees:
    """Boosted regression trees for the logistic loss, as arrays."""

    base: float
    rate: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            while (inner := feature[node] >= 0).any():
                f = np.where(inner, feature[node], 0)
                node = np.where(inner, 2 * node + 1 + (x[rows, f] > cut[node]), node)
            out += self.rate * value[node]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 100, depth: int = 3, rate: float = 0.12, bins: int = 32, least: float = 1.0, ridge: float = 1.0) -> Trees:
    """Gradient boosting of weighted rows with histograms over quantile bins; a node is split while the gain is positive."""
    mean = min(max(float(np.average(y, weights=weight)), 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    for f in range(x.shape[1]):  # rare features: their few values, which quantiles miss
        some = np.unique(x[:, f])
        cuts[f] = (some[:-1] + some[1:]) / 2 if len(some) <= bins else np.unique(np.concatenate([cuts[f], [(some[0] + some[1]) / 2]]))
    code = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin, trees = np.full(len(y), base), []
    size = 2 ** (depth + 1) - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - y) * weight, p * (1 - p) * weight
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        where = {0: np.arange(len(y))}
        for node in range(size):
            rows = where.pop(node, None)
            if rows is None:
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = -gs / (hs + ridge)
            if node >= 2**depth - 1:
                continue
            best = (1e-6, -1, 0)
            for f, c in enumerate(cuts):
                if len(c):
                    gl = np.cumsum(np.bincount(code[rows, f], g[rows], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(code[rows, f], h[rows], len(c) + 1))[:-1]
                    gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                    gain[(hl < least * 0.1) | (hs - hl < least * 0.1)] = 0
                    if f in RISING:  # minus the gradient over the curvature is a side's value
                        gain[(gs - gl) / (hs - hl + ridge) > gl / (hl + ridge)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
            if best[1] >= 0:
                feature[node], cut[node] = best[1], cuts[best[1]][best[2]]
                right = code[rows, best[1]] > best[2]
                where[2 * node + 1], where[2 * node + 2] = rows[~right], rows[right]
        trees.append((feature, cut, value))
        margin += rate * Trees(0.0, 1.0, [trees[-1]]).margin(x)
    return Trees(base, rate, trees)


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (scores, probabilities) to interpolate between."""
    order = np.argsort(score, kind="stable")
    s, v = score[order], y[order].astype(float)
    blocks: list[list[float]] = []
    for a, b in zip(s, v):
        blocks.append([a, a, b, 1.0])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            lo = blocks.pop(-2)
            hi = blocks[-1]
            n = lo[3] + hi[3]
            blocks[-1] = [lo[0], hi[1], (lo[2] * lo[3] + hi[2] * hi[3]) / n, n]
    xs = np.array([x for b in blocks for x in (b[0], b[1])])
    return xs, np.array([b[2] for b in blocks for _ in (0, 1)])


def boost_passages(x: np.ndarray, doc: np.ndarray, y: np.ndarray) -> Trees:
    """Trees from the passages of judged documents (``doc`` ascending): all passages of harmless documents, and of each
    offensive one the passage that stands out most, chosen by evidence first and by the trees so made the second time."""
    score = x[:, FEATURES.index("evidence")] + 0.3 * x[:, FEATURES.index("learned_sum")]
    trees = None
    for _ in range(2):
        order = np.lexsort((-score, doc))
        top = order[np.concatenate([[True], doc[order][1:] != doc[order][:-1]])]
        chosen = np.concatenate([np.flatnonzero(y == 0), top[y[top] == 1]])
        rows, weight = np.unique(np.column_stack([x[chosen], y[chosen]]), axis=0, return_counts=True)
        trees = boost(rows[:, :-1], rows[:, -1].astype(float), weight.astype(float))
        score = trees.margin(x)
    return trees


#: The classifier is fitted on at most so many labelled documents, taken in the order of a hash of their id, and at most so
#: many passages of each, those with most evidence.
MAX_LABELLED = 20_000
MAX_PASSAGES = 200
#: With fewer documents of either judgement in a half than this, the score is the lexicon evidence alone.
MIN_EACH = 12


def judged(labels: DataFrame) -> DataFrame:
    """(doc_id, y): the mean of the judgements of a document; ties and null judgements are left out."""
    return (
        pick(labels, "doc_id", "offensive").where("offensive is not null and doc_id is not null").groupBy("doc_id").agg(F.avg(F.col("offensive").cast("double")).alias("m"))
        .where("m <> 0.5").select("doc_id", (F.col("m") > 0.5).cast("int").alias("y"))
    )


def choose(rows: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """The ``most`` rows with the least hash of their doc_id: ids only, thinned by hash before they are sorted."""
    order = F.xxhash64(F.lit(17), "doc_id")
    n = rows.count()
    if n > 2 * most:
        rows = rows.where(F.pmod(order, F.lit(1_000_000)) < int(1_000_000 * min(1.0, 1.2 * most / n)) + 1)
        order = F.pmod(order, F.lit(1_000_000))
    return rows.orderBy(order, "doc_id").limit(most)


def learn_weights(words: DataFrame, fold: int) -> dict[str, float]:
    """Log-odds weights of words and word pairs in the offensive documents of one fold: all that stand in two or more of them
    and are clearly more frequent there. Their number is bounded by the labelled sample."""
    rows = words.where(F.col("fold") == fold)
    total = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    pos, neg = total.get(1, 0), total.get(0, 0)
    if not pos or not neg:
        return {}
    seen = rows.select("y", F.explode("grams").alias("gram")).groupBy("gram").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).where("a >= 2")
    odds = F.log((F.col("a") + 0.3) / (pos + 0.6)) - F.log((F.col("b") + 0.3) / (neg + 0.6))
    return {r["gram"]: float(r["w"]) for r in seen.select("gram", odds.alias("w")).where("w > 2").collect()}


def _merged(a: dict[str, float], b: dict[str, float]) -> dict[str, float]:
    """The mean of two tables; a word that one lacks weighs nothing there."""
    return {g: (a.get(g, 0.0) + b.get(g, 0.0)) / 2 for g in {**a, **b}}


@dataclass
class Model:
    """What the workers need: per half its word weights and trees, and the curve that calibrates their margins."""

    weights: list[dict[str, float]]
    trees: list[Trees] | None
    curve: tuple[np.ndarray, np.ndarray] | None

    def probability(self, base: np.ndarray, learned: list[np.ndarray], half: int | None) -> float:
        """Of one document. ``half``: that of a judged document, which only the other half's model may score."""
        if self.trees is None or self.curve is None:
            return float(1 / (1 + np.exp(-1.5 * (base[:, FEATURES.index("evidence")].max() - 2.0))))
        use = [0, 1] if half is None else [1 - half]
        return float(np.mean([np.interp(self.trees[k].margin(np.hstack([base, learned[k]])).max(), *self.curve) for k in use]))

    def probabilities(self, documents: list[tuple[np.ndarray, list[np.ndarray]]], halves: list[int | None]) -> np.ndarray:
        """Of many documents at once."""
        if self.trees is None or self.curve is None or not documents:
            return np.array([self.probability(b, x, h) for (b, x), h in zip(documents, halves)])
        first = np.concatenate([[0], np.cumsum([len(b) for b, _ in documents])[:-1]])
        got = []
        for k in (0, 1):
            x = np.concatenate([np.hstack([b, learned[k]]) for b, learned in documents])
            rows, where = np.unique(x, axis=0, return_inverse=True)
            got.append(np.interp(np.maximum.reduceat(self.trees[k].margin(rows)[where.reshape(-1)], first), *self.curve))
        seen = np.array([-1 if h is None else h for h in halves])
        return np.where(seen == 0, got[1], np.where(seen == 1, got[0], (got[0] + got[1]) / 2))


def folds(labels: DataFrame) -> DataFrame:
    """(doc_id, y, fold) of the labelled sample; folds 0 and 1 are one half, 2 and 3 the other."""
    return choose(judged(labels)).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(4)).cast("int"))


def fit(documents: DataFrame, chosen: DataFrame) -> Model:
    """The models of the labelled documents (``chosen``: see :func:`folds`).

    Within a half, word weights are learned on one fold and used for the other's training features, so that no document's
    features come from its own judgement; the other half sees the mean of both.
    """
    sample = materialise(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "fold", "text"), "labelled")  # at most MAX_LABELLED ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(y, f, sorted({g for p in passages(t or "") for g in grams(tokens(p)[0])})) for y, f, t in zip(b.y, b.fold, b.text)]
            yield pd.DataFrame(rows, columns=["y", "fold", "grams"])

    words = materialise(sample.mapInPandas(cut, "y int, fold int, grams array<string>"), "grams")
    tables = [learn_weights(words, k) for k in range(4)]
    weights = [_merged(tables[0], tables[1]), _merged(tables[2], tables[3])]

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer([*tables, *weights])
        for b in batches:
            rows = []
            for d, y, f, t in zip(b.doc_id, b.y, b.fold, b.text):
                base, learned = scorer.document(t)
                x = np.hstack([base, learned[f ^ 1], learned[5 - f // 2]])
                x = np.unique(np.round(x, 2), axis=0)
                if len(x) > MAX_PASSAGES:
                    x = x[np.argsort(-x[:, FEATURES.index("evidence")] - x[:, -1] - x[:, -3], kind="stable")[:MAX_PASSAGES]]
                rows += [(d, y, f, r.tolist()) for r in x]
            yield pd.DataFrame(rows, columns=["doc_id", "y", "fold", "x"])

    # At most MAX_LABELLED documents of at most MAX_PASSAGES passages, as one table of floats.
    got = sample.mapInPandas(featurise, "doc_id long, y int, fold int, x array<float>").toArrow()
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable")
    doc, y, fold = (got[c].to_numpy()[order] for c in ("doc_id", "y", "fold"))
    x = np.concatenate([np.zeros(0, np.float32), *[c.flatten().to_numpy() for c in got["x"].chunks]]).reshape(-1, len(FEATURES) + 2)[order]
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, int)
    half = fold // 2
    for k in (0, 1):
        if min(((y[first] == v) & (half[first] == k)).sum() for v in (0, 1)) < MIN_EACH:
            return Model(weights, None, None)
    n = len(FEATURES)
    trees = [boost_passages(x[half == k, :n], doc[half == k], y[half == k]) for k in (0, 1)]
    held = np.zeros(len(y))
    for k in (0, 1):
        held[half != k] = trees[k].margin(np.hstack([x[:, : n - 2], x[:, n:]])[half != k])
    return Model(weights, trees, isotonic(np.maximum.reduceat(held, first), y[first]))


def scores(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, source, probability, offensive) of every document; null and empty texts score as texts without a passage.

    Judgements of unknown documents are ignored. With too few judgements of either kind the score rests on the lexicons alone.
    """
    documents = pick(documents, "doc_id", "text", "source")
    chosen = materialise(folds(labels), "chosen")
    model = fit(documents, chosen)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model.weights)
        for b in batches:
            halves = [None if pd.isna(h) else int(h) for h in b.half]
            p = model.probabilities([scorer.document(t) for t in b.text], halves)
            yield pd.DataFrame({"doc_id": b.doc_id, "source": b.source, "probability": p})

    known = chosen.select("doc_id", F.floor(F.col("fold") / 2).cast("int").alias("half"))
    rows = documents.select("doc_id", T.source_key(F.col("source")).alias("source"), "text").join(F.broadcast(known), "doc_id", "left")
    got = rows.mapInPandas(score, "doc_id long, source string, probability double")
    return got.withColumn("offensive", F.col("probability") >= threshold)


def rates(scored: DataFrame) -> DataFrame:
    """Per source: documents, offensive ones, their share and the mean probability. A null source is a row of its own."""
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if("offensive").alias("n_offensive"),
        F.round(F.count_if("offensive") / F.count(F.lit(1)), 9).alias("rate"), F.round(F.avg("probability"), 6).alias("mean_probability"),
    )
