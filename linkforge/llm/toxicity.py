"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, settings
from .hashing import Words, lowered, mix, pieces, release
from .linear import fit, flat, score, sigmoid

#: Rows, at most about, that voters, label model and classifier are learnt from.
LABELLED, UNLABELLED = 8_000, 8_000
#: Candidate terms, voters mined from labelled rows, and the least share of toxic rows that a term is in.
CANDIDATES, VOTERS, LEAST_SHARE = 20_000, 150, 0.01
#: Rows of votes that the label model works on at once: the driver holds votes as bytes.
STEP = 1024
THRESHOLD = 0.7
UPPER = re.compile("[A-Z]")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~«»¿¡"
#: A small public vocabulary of insults; a trailing * stands for any ending.
LEXICON = {
    "en": "idiot* moron* stupid* loser* scum* trash worthless pathetic disgusting* clown* dumb* imbecile* jerk* bastard* asshole* bitch* fuck* shit* whore* retard*",
    "fr": "idiot* imbécile* connard* connasse* salaud* salope* putain* merde* débile* crétin* abruti* ordure*",
    "de": "idiot* dummkopf* arschloch* scheiß* schlampe* hurensohn* trottel* abschaum* wichser* vollidiot* missgeburt*",
    "es": "idiota* imbécil* estúpid* cabrón* gilipollas mierda* puta* pendej* basura* escoria* asqueros*",
}
#: Shares of characters from which a text looks like shouting: capitals A-Z, and !.
SHARES = (0.6, 0.02)
#: Patterns that vote for a text in which they occur at all.
PATTERNS = {
    "masked word": r"\w[*@#$%]{2,}\w*",
    "stretched letters": r"([^\W\d_])\1{3}",
    "heaped marks": r"[!?]{3}",
    "capitals in a row": r"(?:\b[A-Z]{4,}\b\W+){3}",
    "digits for letters": r"\b[a-z]+[013457]+[a-z]+\b",
    "curse": r"(?i)\b(?:go to hell|shut up|get lost|drop dead|va te faire|ta gueule|halt die klappe|halt's maul|vete al diablo|cállate)\b",
    "threat": r"(?i)\b(?:kill|hurt|destroy|hate|despise) (?:you|them|him|her|yourself)\b|\bje te (?:hais|déteste)\b|\bich hasse dich\b|\bte odio\b",
    "address": r"(?i)\b(?:you|you're|you are|tu es|espèce de|du bist|eres) (?:an? |un |une |ein |eine )?(?:idiot|moron|stupid|loser|trash|imbécile|connard|trottel|estúpid|imbécil)",
}
#: Buckets of hashed words and beginnings of words, how many of them the classifier looks at, and the
#: texts that one of these must be in.
TEXT_BITS, TEXT_COLUMNS, LEAST_TEXTS = 18, 200, 8


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def terms_of(text: str) -> set[str]:
    """Each word, lower-cased and without outer punctuation, as itself and as its beginnings of four
    to eight characters (with *)."""
    out = set()
    for w in set(text.lower().split()):
        w = w.strip(PUNCTUATION)
        if len(w) >= 3:
            out.add(w)
            out.update(w[:k] + "*" for k in range(4, min(9, len(w) + 1)))
    return out


def term_counts(only: frozenset | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                terms = terms_of(text.as_py())
                found.update(terms if only is None else terms & only)
            if len(found) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["term", "n"])
                found = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(found.keys()), pa.string()), pa.array(list(found.values()), pa.int64())], ["term", "n"])

    return run


class Voters:
    """Terms found by one automaton: for each text which terms occur, and what the patterns see."""

    def __init__(self, terms: list[str]) -> None:
        import ahocorasick

        self.terms, self.machine = terms, ahocorasick.Automaton()
        for i, t in enumerate(terms):
            stem = t.rstrip("*")
            known = self.machine.get(stem, ()) if stem in self.machine else ()
            self.machine.add_word(stem, (*known, (i, len(stem), t.endswith("*"))))
        if terms:
            self.machine.make_automaton()

    def see(self, text: str) -> np.ndarray:
        """Hits of each term, then the share of capitals A-Z and of ! among characters."""
        low, out = text.lower(), np.zeros(len(self.terms) + 2)
        for end, found in self.machine.iter(low) if self.terms else ():
            for i, n, open_ in found:
                begin = end - n
                if (begin < 0 or not low[begin].isalnum()) and (open_ or end + 1 == len(low) or not low[end + 1].isalnum()):
                    out[i] += 1
        if text:
            out[-2], out[-1] = len(UPPER.findall(text)) / len(text), text.count("!") / len(text)
        return out


def pattern_votes(text: str) -> list[bool]:
    return [bool(re.search(x, text)) for x in PATTERNS.values()]


def text_columns(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct words of each text, A-Z lower-cased, and of the first four bytes
    of longer words, hashed; ordered by text."""
    words = Words(lowered(data), bounds)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(words.first))
    long = np.flatnonzero(words.end - words.start > 4)
    begins = np.zeros(len(long), np.uint64)
    for i in range(4):
        begins = begins << np.uint64(8) | words.data[words.start[long] + i]
    hashed = np.r_[words.hashes(), mix(begins + np.uint64(1))] >> np.uint64(64 - TEXT_BITS)
    key = np.unique((np.r_[owner, owner[long]] << TEXT_BITS) + hashed.astype(np.int64))
    return key >> TEXT_BITS, key & ((1 << TEXT_BITS) - 1)


def telling(text: np.ndarray, column: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The buckets whose presence tells most of the posterior labels, in information, sorted."""
    n, all_ = len(p), np.bincount(column, minlength=1 << TEXT_BITS).astype(float)
    some = np.flatnonzero(all_ >= LEAST_TEXTS)
    if not len(some) or not n:
        return np.zeros(0, np.int64)
    both, total = np.bincount(column, p[text], 1 << TEXT_BITS)[some], all_[some]
    share = lambda a, b: np.where(a > 0, a * np.log(np.maximum(a, 1e-12) / np.maximum(b, 1e-12)), 0.0)
    yes, rest = p.sum(), n - total
    gain = share(both, total * yes / n) + share(total - both, total * (n - yes) / n) + share(yes - both, rest * yes / n) + share(np.maximum(rest - yes + both, 0), rest * (n - yes) / n)
    return np.sort(some[np.lexsort((some, -gain))[:TEXT_COLUMNS]])


def features(seen: np.ndarray, text: np.ndarray, column: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """What the classifier looks at: which terms occur, whether any does, how many kinds and how
    often, the shares, and which of the chosen buckets the text's own words fall into."""
    n = seen.shape[1] - 2
    out = np.zeros((len(seen), n + 5 + len(chosen)))
    out[:, :n] = seen[:, :-2] > 0
    kinds = out[:, :n].sum(1)
    out[:, n : n + 5] = np.c_[kinds > 0, np.log1p(kinds), np.log1p(seen[:, :-2].sum(1)), seen[:, -2:]]
    if len(chosen):
        at = np.minimum(np.searchsorted(chosen, column), len(chosen) - 1)
        known = chosen[at] == column
        out[text[known], n + 5 + at[known]] = 0.5
    return out


def votes(seen: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """1: toxic, 0: abstains, -1: clean; the last voter says clean where no term occurs."""
    hits = seen[:, :-2] > 0
    return np.c_[hits, seen[:, -2:] >= SHARES, patterns, -(~hits.any(1)).astype(np.int8)].astype(np.int8)


def label_model(v: np.ndarray, gold: np.ndarray, rounds: int = 25) -> np.ndarray:
    """The probability of each row's label 1. EM on votes given the label; rows with a gold label (0
    or 1; -1: none) keep it. Voters that go together, given the label, share their weight: each
    counts by 1 / (1 + sum of its squared correlations with the others)."""
    n, m = v.shape
    if not n:
        return np.zeros(0)
    parts, states = [slice(at, at + STEP) for at in range(0, n, STEP)], (-1, 0, 1)
    known = gold >= 0
    p = np.where(known, gold, np.where((v > 0).any(1), 0.7, 0.1)).astype(float)
    for _ in range(rounds):
        q = np.stack([1 - p, p])
        prior = (q.sum(1) + 1) / (n + 2)
        sums = sum(np.stack([q[:, i] @ (v[i] == s).astype(float) for s in states]) for i in parts)  # state, label, voter
        table = (sums + 0.1) / (q.sum(1)[:, None] + 0.3)
        mean = (sums[2] - sums[0]) / np.maximum(q.sum(1), 1e-9)[:, None]
        cov = sum((v[i] - mean[y]).T @ ((v[i] - mean[y]) * q[y, i, None]) for i in parts for y in (0, 1)) / n
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        corr = np.clip(cov / sd[:, None] / sd[None, :], -1, 1)
        np.fill_diagonal(corr, 0)
        weight = 1 / (1 + (corr**2).sum(1))
        ratio = np.log(table[:, 1]) - np.log(table[:, 0])
        z = np.log(prior[1] / prior[0]) + np.concatenate([sum((v[i] == s) @ (r * weight) for s, r in zip(states, ratio, strict=True)) for i in parts])
        p = np.where(known, gold, sigmoid(z))
    return p


def mine(labelled: DataFrame) -> list[str]:
    """Terms that are far more frequent in toxic rows; of a word and its beginnings the most specific
    that loses no more than a twentieth of their rows."""
    n1 = labelled.where("toxic = 1").count()
    n0 = labelled.where("toxic = 0").count()
    if not n1 or not n0:
        return []
    count = lambda y, only: labelled.where(F.col("toxic") == y).select("text").mapInArrow(term_counts(only), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    common = count(1, None).where(F.col("n") >= max(3, LEAST_SHARE * n1)).orderBy(F.desc("n"), "term").limit(CANDIDATES).collect()
    toxic = {r.term: r.n for r in common}
    clean = {r.term: r.n for r in count(0, frozenset(toxic)).collect()} if toxic else {}
    strong = {t: n for t, n in toxic.items() if n / n1 >= 20 * (clean.get(t, 0) + 0.5) / n0}
    keep = []
    for t, n in strong.items():
        stem = t.rstrip("*")
        longer = t.endswith("*") and any(u != t and u.rstrip("*").startswith(stem) and (len(u.rstrip("*")) > len(stem) or u == stem) and strong[u] >= 0.95 * n for u in strong)
        if not longer:
            keep.append(t)
    return sorted(keep, key=lambda t: (-strong[t], t))[:VOTERS]


def seer(terms: list[str]):
    """(gold, terms that occur and how often, shares, pattern votes, buckets) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(terms)
        for batch in batches:
            for rows, data, bounds in pieces(batch, "text"):
                texts = rows.column(1).to_pylist()
                text, column = text_columns(data, bounds)
                buckets = pa.ListArray.from_arrays(np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32), pa.array(column.astype(np.int32)))
                seen, patterns = [voters.see(t or "") for t in texts], [pattern_votes(t or "") for t in texts]
                found = [np.flatnonzero(x[:-2]) for x in seen]
                lists = [pa.array(x, pa.list_(t)) for x, t in ((found, pa.int32()), ([x[f] for x, f in zip(seen, found, strict=True)], pa.float64()), ([x[-2:] for x in seen], pa.float64()), (patterns, pa.bool_()))]
                yield pa.RecordBatch.from_arrays([rows.column(0), *lists, buckets], ["gold", "found", "hits", "shares", "patterns", "buckets"])

    return run


class Model(NamedTuple):
    terms: list[str]
    chosen: np.ndarray
    weights: np.ndarray


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The voters' terms, the chosen buckets and the classifier's weights, from at most about
    LABELLED labelled and UNLABELLED unlabelled rows outside the held-out third."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("l_")).agg(F.max("toxic").alias("toxic"))
    own = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chance = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 30)) / float(1 << 30)
    n_gold, n = known.count(), own.count()
    with Scratch(docs.sparkSession) as scratch, settings(docs.sparkSession):
        gold = known.where(chance("l_") < LABELLED / max(1, n_gold * 2 / 3))
        labelled = scratch(own.join(gold, F.col("doc_id") == F.col("l_")).select("text", "toxic").dropDuplicates(), "labelled")
        others = own.where(chance("doc_id") < UNLABELLED / max(1, n)).join(known.select("l_"), F.col("doc_id") == F.col("l_"), "left_anti").select("text", F.lit(-1).alias("toxic"))
        terms = list(dict.fromkeys([*mine(labelled), *(t for words in LEXICON.values() for t in words.split())]))
        rows = labelled.unionAll(others).select(F.col("toxic").alias("gold"), "text").mapInArrow(seer(terms), "gold int, found array<int>, hits array<double>, shares array<double>, patterns array<boolean>, buckets array<int>").toArrow()
    owner = lambda name: np.repeat(np.arange(rows.num_rows, dtype=np.int32), pc.list_value_length(rows.column(name)).to_numpy())
    seen, patterns = np.zeros((rows.num_rows, len(terms) + 2)), flat(rows.column("patterns")).reshape(rows.num_rows, len(PATTERNS))
    seen[owner("found"), flat(rows.column("found")).astype(np.int32)] = flat(rows.column("hits"))
    seen[:, -2:] = flat(rows.column("shares")).reshape(rows.num_rows, 2)
    text, column, gold = owner("buckets"), flat(rows.column("buckets")).astype(np.int32), rows.column("gold").to_numpy()
    del rows
    p = label_model(votes(seen, patterns.astype(bool)), gold)
    chosen = telling(text, column, p)
    model = Model(terms, chosen, fit(features(seen, text, column, chosen), p, l2=0.02))
    del seen, text, column
    release()
    return model


def scorer(model: Model):
    """The first column with the score of the text, which is the second column or, where that is a
    struct, its field text; the struct goes along, so that a text is sent once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(model.terms)
        for batch in batches:
            packed = pa.types.is_struct(batch.column(1).type)
            texts = batch.column(1).field("text") if packed else batch.column(1)
            scores = [np.zeros(0)]
            for rows, data, bounds in pieces(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
                seen = np.array([voters.see(t.as_py() or "") for t in rows.column(0)]).reshape(rows.num_rows, len(model.terms) + 2)
                scores.append(sigmoid(score(features(seen, *text_columns(data, bounds), model.chosen), model.weights)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores)), *([batch.column(1)] if packed else [])], ["doc_id", "score", *(["row_"] if packed else [])])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text); labels has doc_id and
    toxic (0, 1 or null; of several labels of one doc_id the highest counts).

    Voters are a small lexicon, patterns, and terms mined from labelled rows; the label model weighs
    them by what it estimates of their accuracies and correlations (rows with a label keep it). A
    linear classifier learns the posterior labels from the terms and from the text's own hashed words
    and beginnings of words, those that tell most of the posteriors, and scores every whole text, one
    by one, without a shuffle. Rows whose
    crc32(doc_id as text) mod 3 is 1 are held out: neither their labels nor their texts are learnt
    from. Null and empty texts are scored as texts without hits; rows with null doc_id are scored and
    not held out; without labels the lexicon alone decides; an empty table gives no rows; other
    columns are not looked at."""
    model = learn(docs, labels)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scorer(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all their columns, that toxicity() doesn't reject; scored in place, so rows
    that repeat a doc_id are judged by their own texts."""
    model = learn(docs, labels)
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*docs.columns).alias("row_"))
    kept = packed.mapInArrow(scorer(model), f"doc_id long, score double, row_ {packed.schema['row_'].dataType.simpleString()}").where(F.col("score") < threshold)
    return kept.select(*[F.col("row_")[c].alias(c) for c in docs.columns])
