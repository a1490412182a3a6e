"""Language identification by cross-parsing entropy.

For every language a suffix automaton of a bounded sample of labelled text is
built. A document is parsed against each automaton from left to right into the
longest pieces that occur in that language's sample; the language that needs the
fewest phrases per character wins (ties: the smaller name). The whole text is
parsed, in lanes of ``LANE`` characters that run through the transition table
together, one gather per step; a phrase ends at a lane's end. Every symbol of the
samples has its transitions: the ``alphabet - 1`` most frequent ones as columns of
the table, the others (rare letters, most of a Chinese sample) as sorted keys.

Text is lower-cased, runs of characters that are no letters become one blank.

Sample (documented bound): of the ``max_langs`` labels with the most rows, per language
at most ``sample_rows`` labelled rows in
the order of a hash of doc_id, those of at most ``train_chars / 4`` characters
first, distinct texts, up to ``train_chars`` characters in all. Only rows whose
crc32 of doc_id leaves a remainder other than 0 by 5 are learned from; language,
source and doc_id are never inputs of a prediction.

Defined results: null or letterless text is ``und`` with score 0, as is every
text if nothing could be learned; repeated rows are predicted row by row; a null
doc_id is neither held out nor learned from; of rows that repeat a doc_id one text is
learned from; an empty table gives no rows; extra columns are ignored, and columns to
keep that are called lang_pred, score or n_letters give way to the results; long texts
are parsed whole. ``score`` is 1 - best / second best phrase rate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window
from pyspark.sql.types import StringType

from .common import chunks, give_back, utf8

SAMPLE_ROWS, TRAIN_CHARS, ALPHABET, LANE, FOLDS, MAX_LANGS = 64, 20_000, 48, 384, 5, 512


def _tables() -> tuple[np.ndarray, np.ndarray]:
    low = np.arange(1 << 16, dtype=np.int32)
    letter = np.zeros(1 << 16, bool)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            if len(c.lower()) == 1:
                low[i] = ord(c.lower())
    return low, letter


_held = []


def letters(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points with blanks for runs of no letters, offsets by row, letters by row)."""
    if not _held:
        _held.append(_tables())
    low, letter = _held[0]
    cp = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int32)
    heads = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    at = heads[off]
    small = np.minimum(cp, 0xFFFF)
    is_letter = letter[small] & (cp < 1 << 16)
    far = np.flatnonzero(cp >= 1 << 16)
    if len(far):
        kinds, back = np.unique(cp[far], return_inverse=True)
        is_letter[far] = np.array([chr(c).isalpha() for c in kinds.tolist()])[back]
    out = np.where(is_letter, np.where(cp < 1 << 16, low[small], cp), 32)
    stay = is_letter.copy()
    stay[1:] |= is_letter[:-1]  # one blank after a run of letters
    first = np.zeros(len(cp), bool)
    first[at[:-1][at[:-1] < len(cp)]] = True
    stay &= is_letter | ~first
    kept = np.concatenate(([0], np.cumsum(stay)))
    seen = np.concatenate(([0], np.cumsum(is_letter)))
    return out[stay], kept[at], np.diff(seen[at])


def automaton(text: list[int]) -> list[dict[int, int]]:
    """The moves {symbol: next} of each state of the automaton of all substrings of ``text``; state 1 is the start."""
    nxt, link, size = [{}, {}], [0, 0], [0, 0]
    last = 1
    for c in text:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        else:
            q = nxt[p][c]
            if size[q] == size[p] + 1:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


def dense(moves: list[dict[int, int]], width: int) -> np.ndarray:
    """next[state, symbol] of the symbols below ``width``, 0 where there is none."""
    table = np.zeros((len(moves), width), np.int32)
    for s, m in enumerate(moves):
        for c, t in m.items():
            if c < width:
                table[s, c] = t
    return table


def sparse(moves: list[dict[int, int]], width: int) -> np.ndarray:
    """Rows (state, symbol, next) of the symbols from ``width`` on."""
    return np.array([(s, c, t) for s, m in enumerate(moves) for c, t in m.items() if c >= width], np.int64).reshape(-1, 3)


def suffix_automaton(text: list[int], width: int) -> np.ndarray:
    """Transition table of the automaton of all substrings of ``text`` (symbols 0 to width - 1):
    next[state, symbol], 0 where there is none; state 1 is the start."""
    return dense(automaton(text), width)


class Model:
    """The automata of all languages in one transition table; states are row offsets in it."""

    def __init__(self, samples: dict[str, list[str]], alphabet: int = ALPHABET, train_chars: int = TRAIN_CHARS):
        texts = {}
        for lang in sorted(samples):
            parts, left = [], train_chars
            for t in dict.fromkeys(samples[lang]):
                data = t.encode()
                sym, _, _ = letters(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
                if len(sym) and left > 0:
                    parts.append(np.append(sym, 32)[:left])
                    left -= len(parts[-1])
            if parts:
                texts[lang] = np.concatenate(parts)
        self.langs = list(texts)
        self.width = alphabet
        self.codes = np.zeros(0, np.int64)
        if not texts:
            return
        sym, n = np.unique(np.concatenate(list(texts.values())), return_counts=True)
        often = sym[np.argsort(-n, kind="stable")]
        often = np.concatenate((np.sort(often[: alphabet - 1]), np.sort(often[alphabet - 1:])))
        order = np.argsort(often)
        self.codes, self.code_of = often[order], (order + 1).astype(np.int32)
        self.n_codes = max(len(often) + 1, alphabet)
        tables, wide, base, roots = [], [], 0, []
        for lang in self.langs:
            states = automaton(self.code(texts[lang]).tolist())
            t = dense(states, alphabet)
            tables.append(np.where(t > 0, (t + base) * alphabet, 0))
            wide.append(sparse(states, alphabet) + np.array([base, 0, base]))
            roots.append((base + 1) * alphabet)
            base += len(t)
        self.next = np.concatenate(tables).astype(np.int32).reshape(-1)
        self.roots = np.array(roots, np.int32)
        state, symbol, to = np.concatenate(wide).T
        keys = state * self.n_codes + symbol
        order = np.argsort(keys)
        self.wide_keys, self.wide_next = keys[order], (to[order] * alphabet).astype(np.int32)
        start = np.repeat(self.roots[:, None], self.n_codes, 1)
        fresh = self.moves(start, np.arange(self.n_codes, dtype=np.int32))
        self.fresh = np.where(fresh > 0, fresh, start).astype(np.int32)

    def code(self, symbols: np.ndarray) -> np.ndarray:
        """1 and more for symbols of the samples (below the table's width for frequent ones), 0 for others."""
        i = np.minimum(np.searchsorted(self.codes, symbols), len(self.codes) - 1)
        return np.where(self.codes[i] == symbols, self.code_of[i], 0).astype(np.int32)

    def moves(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """[language, lane]: the next states for the lanes' symbols ``c``, 0 where there is none."""
        wide = np.flatnonzero(c >= self.width)
        if not len(wide):
            return self.next[state + c]
        out = self.next[state + np.where(c < self.width, c, 0)]
        key = state[:, wide].astype(np.int64) // self.width * self.n_codes + c[wide]
        i = np.minimum(np.searchsorted(self.wide_keys, key), len(self.wide_keys) - 1)
        out[:, wide] = np.where(self.wide_keys[i] == key, self.wide_next[i], 0)
        return out

    def phrases(self, symbols: np.ndarray, off: np.ndarray) -> np.ndarray:
        """[language, row]: phrases in the cross-parsing of each row."""
        rows, n_lang = len(off) - 1, len(self.langs)
        size = np.diff(off)
        per_row = -(-size // LANE)
        lane_row = np.repeat(np.arange(rows), per_row)
        k = np.arange(len(lane_row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        start = off[lane_row] + k * LANE
        length = np.minimum(off[lane_row + 1] - start, LANE)
        order = np.argsort(-length, kind="stable")
        start, length, lane_row = start[order], length[order], lane_row[order]
        coded = self.code(symbols)
        active = np.searchsorted(-length, -np.arange(LANE), "left")  # lanes longer than j
        state = np.repeat(self.roots[:, None], len(start), 1)
        count = np.ones((n_lang, len(start)), np.int32)  # the last phrase of a lane
        for j in range(int(length[0]) if len(length) else 0):
            m = int(active[j])
            c = coded[start[:m] + j]
            s = self.moves(state[:, :m], c)
            fail = s == 0
            count[:, :m] += fail
            state[:, :m] = np.where(fail, self.fresh[:, c], s)
        return np.stack([np.bincount(lane_row, x, minlength=rows) for x in count]) if len(start) else \
            np.zeros((n_lang, rows))

    def predict(self, buf: np.ndarray, off: np.ndarray) -> tuple[list[str], list[float], list[int]]:
        """(language, score, letters) of each row."""
        sym, at, n_letters = letters(buf, off)
        if not self.langs:
            return ["und"] * (len(off) - 1), [0.0] * (len(off) - 1), n_letters.tolist()
        rate = self.phrases(sym, at) / np.maximum(np.diff(at), 1)
        best = rate.argmin(0)
        if len(self.langs) > 1:
            two = np.partition(rate, 1, axis=0)[:2]
            score = np.where(two[1] > 0, 1 - two[0] / np.where(two[1] > 0, two[1], 1), 0.0)
        else:
            score = np.ones(rate.shape[1])
        none = n_letters == 0
        return ([("und" if z else self.langs[b]) for b, z in zip(best.tolist(), none.tolist())],
                np.where(none, 0.0, score).tolist(), n_letters.tolist())


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, train_chars: int = TRAIN_CHARS,
        alphabet: int = ALPHABET, max_langs: int = MAX_LANGS) -> Model:
    """Learn from the labelled rows of ``docs`` (doc_id, text, lang) that are not held out."""
    ok = (F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
          & (F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0))
    part = max(train_chars // 4, 1)
    cand = docs.where(ok).select(F.col("doc_id").cast("string").alias("d"), F.col("lang").cast("string").alias("lang"),
                                 F.length("text").alias("n"), F.md5(F.col("doc_id").cast("string")).alias("h"))
    w = Window.partitionBy("lang").orderBy((F.col("n") > part).cast("int"), "h", "n")
    # rows that repeat a doc_id are one candidate; the most frequent labels are learned
    common = cand.groupBy("lang").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "lang").limit(max_langs).select("lang")
    cand = cand.join(F.broadcast(common), "lang").distinct()
    ids = cand.withColumn("r", F.row_number().over(w)).where(F.col("r") <= sample_rows).select("d", "lang", "r", "n")
    # at most sample_rows texts per language, one for each candidate, each cut to the sample's bound
    rows = (docs.where(ok).select(F.col("doc_id").cast("string").alias("d"), F.col("lang").cast("string").alias("lang"),
                                  F.length("text").alias("n"), F.substring("text", 1, train_chars).alias("text"))
            .join(F.broadcast(ids), ["d", "lang", "n"])
            .groupBy("lang", "r").agg(F.min("text").alias("text")).collect())
    samples: dict[str, list[str]] = {}
    for x in sorted(rows, key=lambda x: (x["lang"], x["r"], x["text"])):
        samples.setdefault(x["lang"], []).append(x["text"])
    return Model(samples, alphabet, train_chars)


def predict(docs: DataFrame, model: Model, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred, score and n_letters of every row of ``docs``, from the column ``text`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages * train_chars

    def run(batches):
        m = shared.value
        for batch in batches:
            buf, off = utf8(batch.column(at))
            for a, b in chunks(off):
                langs, scores, counts = m.predict(buf[off[a]: off[b]], off[a: b + 1] - off[a])
                rows = batch.slice(a, b - a)  # handed on as they are done: the executor holds no whole batch of results
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:len(keep)], pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                     pa.array(counts, pa.int64())], [*keep, "lang_pred", "score", "n_letters"])
        give_back()

    keep = tuple(c for c in keep if c not in ("lang_pred", "score", "n_letters"))
    kept = docs.select(*keep)
    if text in keep and kept.schema[text].dataType == StringType():  # one copy of the text for both
        src, at = kept, keep.index(text)
    else:
        src, at = docs.select(*keep, F.col(text).cast("string").alias("__text")), len(keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields),
                        "lang_pred STRING", "score DOUBLE", "n_letters BIGINT"])
    return src.mapInArrow(run, schema)


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang)."""
    model = fit(docs, **options)
    out = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, "doc_id")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
