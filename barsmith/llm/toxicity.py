"""Toxicity by a support vector machine on a gap-weighted subsequence kernel with Nystroem landmarks.

A text is sentences, a sentence is words, and a word is compared by the subsequence kernel of order three: two words are
alike as far as they share three-character subsequences, each weighted by DECAY to the power of its span, spans up to SPAN, with marks
at both ends. So gapped and padded insults stay near the plain ones; runs of single characters are read as one word. The machine
learns from labelled sentences under the multiple-instance view: no word of a clean text's sentence is toxic, some word
of a toxic text's sentences is. It starts from words that occur in far more toxic than clean texts, maps words through
the kernel with LANDMARKS of them (Nystroem), separates them by a linear SVM, and trains again with the words of clean texts
that it got wrong. The kernel expands explicitly, so the trained machine is one weight per subsequence, and scoring does not
depend on the number of landmarks.

A text's score is a logistic function of its best sentence, its share of toxic words and its number of toxic sentences. All words
of a text are scored; words of over WORD bytes in overlapping windows.

Training reads at most TRAIN_ROWS labelled rows, those with the least hash of doc_id, and of them as many as hold TRAIN_BYTES of text;
scoring has no bound. The machine is fitted in one task from the sample's word counts; the driver gets its weights.

Defined cases: null and empty texts have no words and score as a text without any toxic one; where few toxic texts are labelled,
so that no word is common among them (MIN_TEXTS, MIN_SHARE, MIN_RATIO), words of two toxic texts start the machine, or else of one,
if they are likelier in toxic texts at all; where there are no such words either, all texts score the sample's toxic share; without labelled rows of both
kinds all scores are 0; labels other than 0 and 1 are left out; repeated rows are texts of their own; a null doc_id counts as the
text '' in the fold; extra columns are ignored.
"""

import multiprocessing
import string
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsmith.llm.arrays import LOWER, claim, release, span_hashes, text_slices, word_spans
from barsmith.session import stage

TRAIN_ROWS, TRAIN_BYTES, LANDMARKS, NEGATIVES, ROUNDS = 8000, 64 << 20, 160, 12_000, 3
DECAY, SPAN, WORD = 0.6, 5, 24
MIN_TEXTS, MIN_SHARE, MIN_RATIO, CACHE = 5, 0.01, 6.0, 400_000  # a seed word's toxic texts: number, share of all; against clean ones
_EDGE = (2, 3)  # marks of a word's ends
_ENDS = np.isin(np.arange(256), list(b".!?\n"))
_TRIM = (string.punctuation + "\x7f").encode()
FACTS = "best double, toxic_words long, toxic_sentences long, n_words long"


def subsequences(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, subsequence code, weight) of all words, summed per code and scaled to length one; sorted."""
    width = WORD + 2
    raw = b"".join(bytes(_EDGE[:1]) + w[:WORD] + bytes(_EDGE[1:]) + b"\0" * (width - 2 - len(w[:WORD])) for w in words)
    x = np.frombuffer(raw, np.uint8).reshape(-1, width).astype(np.int64)
    keys, values = [], []
    for one in range(1, SPAN):
        for two in range(1, SPAN - one + 1):
            n = width - one - two
            code = x[:, :n] << 16 | x[:, one:one + n] << 8 | x[:, one + two:]
            at, place = np.nonzero(x[:, one + two:])
            keys.append(at << 24 | code[at, place])
            values.append(np.full(len(at), DECAY ** (one + two)))
    keys, values = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    keys = keys[first]
    values = np.add.reduceat(values, first) if len(first) else values
    word = keys >> 24
    norm = np.sqrt(np.bincount(word, values * values, len(words)))
    return word, keys & 0xFFFFFF, values / norm[word]


def windows(word: bytes) -> list[bytes]:
    """The word without outer punctuation, and without any; a long one as overlapping windows."""
    word, bare = word.strip(_TRIM), word.translate(None, _TRIM)
    if bare != word and bare:
        return windows(bare) + ([word] if len(word) <= WORD else [])
    return [word] if len(word) <= WORD else [word[i:i + WORD] for i in range(0, len(word) - WORD // 2, WORD // 2)]


class Machine:
    """decision(word) = weights . subsequences(word) + bias, kept per word hash."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray, bias: float):
        self.codes, self.weights, self.bias = codes, weights, bias
        self.known: dict[int, float] = {}

    def __getstate__(self):
        return self.codes, self.weights, self.bias

    def __setstate__(self, state):
        self.__init__(*state)

    def decisions(self, words: list[bytes], step: int = 4000) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for lo in range(0, len(words), step):
            part = words[lo:lo + step]
            word, code, value = subsequences(part)
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[at] == code
            out[lo:lo + len(part)] += np.bincount(word[hit], value[hit] * self.weights[at[hit]], len(part))
        return out

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """The highest decision of each word's windows."""
        parts = [windows(w) for w in words]
        sizes = np.array([len(p) for p in parts])
        got = self.decisions([w for p in parts for w in p])
        return np.maximum.reduceat(got, np.cumsum(sizes) - sizes) if len(words) else got

    def of_hashes(self, hashes: np.ndarray, word_at) -> np.ndarray:
        """Decisions by word hash; word_at(positions) gives the bytes of new ones."""
        if len(self.known) > CACHE:
            self.known.clear()
        keys = hashes.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            self.known.update(zip([keys[i] for i in new], self.of_words(word_at(new)).tolist()))
        return np.array([self.known[k] for k in keys])


def spaced_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[tuple[int, bytes]]:
    """(first word, joined bytes) of runs of three or more single-character words within a row."""
    lead = data[starts] if len(starts) else data[:0]
    width = np.where(lead < 0xC0, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
    single = (ends - starts) == width
    if single.sum() < 3:
        return []
    head = np.zeros(len(starts) + 1, bool)
    head[first] = True
    edge = np.flatnonzero(np.diff(np.append(np.append(False, single), False).astype(np.int8)) | head)
    cuts = zip(edge[:-1].tolist(), edge[1:].tolist())
    return [(a, b"".join(data[starts[i]:ends[i]].tobytes() for i in range(a, b))) for a, b in cuts if b - a >= 3 and single[a:b].all()]


def text_facts(batches, machine: Machine, lead: int):
    """The first `lead` columns as they are, then FACTS of the text column that follows them."""
    claim("toxicity", machine.known.clear)
    names = [*(f"c{i}" for i in range(lead)), "best", "toxic_words", "toxic_sentences", "n_words"]
    for b in batches:
        for lo, hi, raw, offsets in text_slices(b.column(lead)):
            data = LOWER[raw]
            starts, ends, first = word_spans(data, offsets)
            hashes, at, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
            f = machine.of_hashes(hashes, lambda new: [data[starts[at[i]]:ends[at[i]]].tobytes() for i in new])[back]
            for place, word in spaced_words(data, starts, ends, first):
                f[place] = max(f[place], machine.of_words([word])[0])
            n = np.diff(first)
            row = np.repeat(np.arange(hi - lo), n)
            toxic = f > 0
            sentence = np.append(0, np.cumsum(_ENDS[data]))[starts]
            pairs = np.unique(np.stack([row[toxic], sentence[toxic]]), axis=1)
            best = np.full(hi - lo, -1.0)
            np.maximum.at(best, row, f)
            yield pa.RecordBatch.from_arrays([
                *(b.column(i)[lo:hi] for i in range(lead)), pa.array(best), pa.array(np.bincount(row[toxic], minlength=hi - lo)),
                pa.array(np.bincount(pairs[0], minlength=hi - lo)), pa.array(n.astype(np.int64))], names=names)


def features(best, toxic_words, toxic_sentences, n_words) -> np.ndarray:
    best, words, sentences, n = (np.asarray(x, float) for x in (best, toxic_words, toxic_sentences, n_words))
    return np.stack([np.ones(len(best)), np.clip(best, -1, 1.5), np.log1p(words), np.log1p(sentences),
                     np.log1p(300 * words / np.maximum(n, 1))], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = p * (1 - p) + 1e-6
        beta += np.linalg.solve((x * w[:, None]).T @ x + ridge * len(y) * np.eye(len(beta)) / 100, x.T @ (y - p) - ridge * len(y) / 100 * beta)
    return beta


def linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, epochs: int = 400) -> np.ndarray:
    """Squared hinge by accelerated gradient steps; the last column of x is the bias."""
    w = np.zeros(x.shape[1])
    v, t = w.copy(), 1.0
    rate = 1 / (2 * np.linalg.norm((x * weight[:, None]).T @ x, 2) + ridge)
    for _ in range(epochs):
        slack = np.maximum(1 - y * (x @ v), 0) * weight
        new = v - rate * (-2 * x.T @ (y * slack) + ridge * np.append(v[:-1], 0))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        w, v, t = new, new + (t - 1) / t2 * (new - w), t2
    return w


def train_machine(words: list[bytes], toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> Machine | None:
    """words with the numbers of toxic and clean texts that hold them in a sentence."""
    ratio = (toxic / max(n_toxic, 1)) / ((clean + 0.5) / (n_clean + 1))
    for texts, least in ((max(MIN_TEXTS, MIN_SHARE * n_toxic), MIN_RATIO), (2, MIN_RATIO), (1, 1.0)):
        seeds = np.flatnonzero((toxic >= texts) & (ratio >= least))
        if len(seeds):
            break
    else:
        return None
    seeds = seeds[np.argsort(-(toxic[seeds] * np.log(ratio[seeds])), kind="stable")]
    order = np.argsort([hash_of(w) for w in words], kind="stable")
    order = order[(clean[order] > 0) & ~np.isin(order, seeds)]
    marks = np.append(seeds[:LANDMARKS * 3 // 4], order[:LANDMARKS // 4])
    word, code, value = subsequences([words[i] for i in marks])
    codes, column = np.unique(code, return_inverse=True)
    basis = np.zeros((len(codes), len(marks)))
    basis[column, word] = value

    def kernel(part: list[bytes]) -> np.ndarray:
        rows = []
        for lo in range(0, len(part), 1000):
            some = part[lo:lo + 1000]
            word, code, value = subsequences(some)
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            hit = codes[at] == code
            dense = np.zeros((len(some), len(codes)))
            dense[word[hit], at[hit]] = value[hit]
            rows.append(dense @ basis)
        return np.concatenate(rows)
    val, vec = np.linalg.eigh(basis.T @ basis)
    root = vec @ np.diag(np.where(val > 1e-8, np.maximum(val, 1e-8) ** -0.5, 0)) @ vec.T
    chosen, machine = order[:NEGATIVES], None
    for round_ in range(ROUNDS):
        at = np.append(seeds, chosen)
        y = np.append(np.ones(len(seeds)), -np.ones(len(chosen)))
        weight = np.append(toxic[seeds] / toxic[seeds].sum(), np.log1p(clean[chosen]) / np.log1p(clean[chosen]).sum() if len(chosen) else [])
        x = np.hstack([kernel([words[i] for i in at]) @ root, np.ones((len(at), 1))])
        w = linear_svm(x, y, weight)
        machine = Machine(codes, basis @ (root @ w[:-1]), float(w[-1]))
        if round_ < ROUNDS - 1 and len(order):  # words of clean texts on the wrong side or near it
            f = machine.decisions([words[i] for i in order])
            chosen = np.union1d(chosen, order[np.argsort(-f, kind="stable")[:NEGATIVES // 4]])
    return machine


NOTHING = Machine(np.zeros(1, np.int64), np.zeros(1), -1.0)  # finds no word toxic


def hash_of(word: bytes) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0]) if len(data) else 0


def vocabulary(sample: DataFrame) -> DataFrame:
    """word, toxic, clean: in how many texts of either label some sentence holds the word; sample: (toxic int, text)."""
    def run(batches):
        for b in batches:
            labels = np.asarray(b.column(0))
            for lo, hi, raw, offsets in text_slices(b.column(1)):
                data = LOWER[raw]
                starts, ends, first = word_spans(data, offsets)
                hashes = span_hashes(data, starts, ends)
                row = np.repeat(np.arange(hi - lo), np.diff(first))
                order = np.lexsort((row, hashes))
                new = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1]))[:len(order)]
                at = order[new]  # one place per word and text
                _, one, back = np.unique(hashes[at], return_index=True, return_inverse=True)
                bad = np.bincount(back, labels[lo:hi][row[at]], len(one)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([data[starts[at[i]]:ends[at[i]]].tobytes().strip(_TRIM) for i in one], pa.binary()), pa.array(bad),
                    pa.array(np.bincount(back, minlength=len(one)) - bad)], names=["word", "toxic", "clean"])
    return sample.mapInArrow(run, "word binary, toxic long, clean long").filter(
        F.octet_length("word").between(2, WORD)).groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _fitted(table: pa.Table, n_toxic: int, n_clean: int, answer) -> None:
    words = table.column("word").to_pylist()
    order = np.argsort([hash_of(w) for w in words], kind="stable")
    answer.send(train_machine([words[i] for i in order], table.column("toxic").to_numpy()[order], table.column("clean").to_numpy()[order],
                              n_toxic, n_clean))


def fit(n_toxic: int, n_clean: int, batches):
    """The machine as one row (no row if there is none), from all rows of `vocabulary` in one task.

    It is fitted in a child process: the worker serves other tasks later, and would keep the memory that the words' objects took.
    """
    batches = list(batches)
    if not batches:
        return
    receive, answer = multiprocessing.Pipe(duplex=False)
    child = multiprocessing.get_context("fork").Process(target=_fitted, args=(pa.Table.from_batches(batches), n_toxic, n_clean, answer))
    child.start()
    answer.close()  # the child's end; a child that dies ends the wait below, and fails the task
    machine = receive.recv()
    child.join()
    del batches
    release()
    if machine is not None:
        yield pa.RecordBatch.from_arrays([pa.array([machine.codes.tobytes()], pa.binary()), pa.array([machine.weights.tobytes()], pa.binary()),
                                          pa.array([float(machine.bias)])], names=["codes", "weights", "bias"])


def fold_of(fold: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % fold


def train(docs: DataFrame, labels: DataFrame, fold: int = 5, rows: int = TRAIN_ROWS):
    """(machine, logistic weights), or None if there is nothing to separate. Rows whose crc32 modulo fold is 0 are not read."""
    marked = labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    picked = marked.filter(fold_of(fold) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sample = stage(texts.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text"), "labelled")
    upto = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)  # at most TRAIN_ROWS sizes
    sizes = sample.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"))
    within = sizes.withColumn("before", F.coalesce(F.sum("bytes").over(upto), F.lit(0))).where(F.col("before") < TRAIN_BYTES)
    sample = sample.join(F.broadcast(within.select("doc_id")), "doc_id", "left_semi").select("toxic", "text")
    counts = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    fitted = vocabulary(sample).repartition(1).mapInArrow(partial(fit, counts[1], counts[0]), "codes binary, weights binary, bias double").first()
    machine = NOTHING if fitted is None else Machine(np.frombuffer(fitted.codes, np.int64), np.frombuffer(fitted.weights), fitted.bias)
    facts = sample.mapInArrow(lambda it: text_facts(it, machine, 1), "toxic int, " + FACTS).toArrow()
    x = features(*(facts.column(n).to_numpy() for n in ("best", "toxic_words", "toxic_sentences", "n_words")))
    return machine, logistic(x, facts.column("toxic").to_numpy().astype(float))


def with_scores(docs: DataFrame, labels: DataFrame, fold: int = 5) -> DataFrame:
    """The rows of docs as they are, plus score and FACTS."""
    trained = train(docs, labels, fold)
    lead = len(docs.columns)
    names = [f"c{i}" for i in range(lead)]
    rows = docs.toDF(*names).withColumn("text_", F.col(names[docs.columns.index("text")]).cast("string"))
    if trained is None:
        return docs.select("*", F.lit(0.0).alias("score"), F.lit(-1.0).alias("best"),
                           *(F.lit(0).cast("long").alias(n) for n in ("toxic_words", "toxic_sentences", "n_words")))
    sent = docs.sparkSession.sparkContext.broadcast(trained[0])
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)) + ", " + FACTS
    facts = rows.mapInArrow(lambda it: text_facts(it, sent.value, lead), schema)
    share = 300 * F.col("toxic_words") / F.greatest("n_words", F.lit(1))
    parts = (F.lit(1.0), F.least(F.greatest("best", F.lit(-1.0)), F.lit(1.5)), F.log1p("toxic_words"), F.log1p("toxic_sentences"),
             F.log1p(share))
    total = sum((F.lit(b) * p for b, p in zip(trained[1].tolist(), parts)), F.lit(0.0))
    found = ("best", "toxic_words", "toxic_sentences", "n_words")
    return facts.withColumn("score_", 1 / (1 + F.exp(-total))).select(*names, "score_", *found).toDF(*docs.columns, "score", *found)


def score_documents(docs: DataFrame, labels: DataFrame, fold: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted and the facts a score rests on, per document."""
    scored = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, fold)
    return scored.select("doc_id", (fold_of(fold) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "toxic_words", "toxic_sentences", "n_words")
