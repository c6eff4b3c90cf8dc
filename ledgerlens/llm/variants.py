"""Spelling variants: words that differ by one code point, and the frequent form of each.

``observed_words`` counts the words of whole texts. ``near_words`` finds all pairs at one inserted,
deleted or replaced code point. A word that differs from x in position i alone shares the prefix
before i and the suffix after i with it. In a set of words of one length, the first are an interval
of the forward order and the second one of the reverse order: a rectangle in which each word is one
point. A wavelet tree (as a matrix of bits) over the set reports a rectangle's points in time by
their number. A missing code point asks the words that are one longer, with the same rectangles.

The sets are dealt over the cluster by parts of words: a pair that differs within the second half of
a word shares the first half, and the other way round. So each word goes to the sets of its two
halves (and of its place among the words one longer), and sets go by hash into tasks. A set of too
many words is cut again, its words meeting by halves of the half, until a set holds words that
differ in one place only: those are as many as there are letters at most. No pair is found twice: a
replacement has one place, and of the places that give the same insertion only the first counts.

Defined results. A null or empty text has no words; a null doc_id is the empty string in the hash.
Rows that repeat count again. Equal counts: the word smallest in code-point order is the form. Very
long words are words like others. An empty table gives an empty one; columns beyond doc_id and text
are not looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: Least code points and occurrences of a word, and how much more frequent a form is.
LEAST_CHARS, LEAST_COUNT, FORM_RATIO = 6, 5, 5
#: Runs whose hash this divides lose a code point.
SLIP = 199
LETTERS = r"A-Za-zÀ-ÿ"
#: Words and code points that a set may hold before it is cut, and that a task takes.
SET_ROWS, SET_CHARS = 5_000, 4_000_000
TASK_ROWS, TASK_CHARS = 50_000, 8_000_000
#: Rectangles asked at once.
QUERIES = 65_536
#: Counts grow by FORM_RATIO with each step to a form, so no chain is longer than 2 to this.
ROUNDS = 5


def observed_words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n: maximal runs of letters, A-Z lower-cased; one in SLIP of (document, run) loses the
    code point that its hash names."""
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.withColumn("run", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    rows = rows.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    rows = rows.withColumn("at", (F.col("h") % F.length("run")).cast("int"))
    short = F.concat(F.substring("run", F.lit(1), F.col("at")), F.substring("run", F.col("at") + 2, F.length("run")))
    word = F.when(F.col("h") % SLIP == 0, short).otherwise(F.col("run"))
    counts = rows.select(word.alias("word")).filter(F.length("word") >= least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _slot(word: Column, cls: Column, a: Column, b: Column, short: Column) -> Column:
    """Hash of what the words of a set share: length, free places [a, b), and all outside of them."""
    tail = F.substring(word, b + F.when(short, 0).otherwise(1), F.length(word))
    return F.xxhash64(cls, a, b, F.substring(word, F.lit(1), a), tail)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with a column ``free`` of (a, b) intervals, one row for each."""
    rows = rows.withColumn("free", F.explode("free")).select("word", "n", "cls", "short", F.col("free.a").alias("a"), F.col("free.b").alias("b"))
    return rows.withColumn("slot", _slot(F.col("word"), F.col("cls"), F.col("a"), F.col("b"), F.col("short")))


def _halves(a: Column, b: Column) -> Column:
    middle = F.floor((a + b) / 2).cast("int")
    return F.array(F.struct(a.cast("int").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), b.cast("int").alias("b")))


def sets(words: DataFrame, set_rows: int = SET_ROWS, set_chars: int = SET_CHARS) -> DataFrame:
    """word, n, cls (length of the set's words), short (one less), a, b, slot: where words meet."""
    roles = F.array(F.struct(F.length("word").alias("cls"), F.lit(False).alias("short")), F.struct((F.length("word") + 1).alias("cls"), F.lit(True).alias("short")))
    rows = words.withColumn("role", F.explode(roles)).select("word", "n", "role.*")
    rows = _dealt(rows.withColumn("free", _halves(F.lit(0), F.col("cls"))))
    done = None
    while True:
        sizes = rows.groupBy("slot").agg(F.count(F.lit(1)).alias("size"), F.max(F.col("b") - F.col("a")).alias("width"), F.max("cls").alias("chars"))
        large = shared.stored(sizes.filter((F.col("width") > 1) & ((F.col("size") > set_rows) | (F.col("size") * F.col("chars") > set_chars))).select("slot"), "variant-large", narrow=True)
        n = large.count()
        if not n:
            return rows if done is None else done.unionByName(rows)
        small = rows.join(shared.small(large, n), "slot", "left_anti")
        done = small if done is None else done.unionByName(small)
        cut = rows.join(shared.small(large, n), "slot", "left_semi").withColumn("free", _halves(F.col("a"), F.col("b")))
        rows = shared.stored(_dealt(cut), "variant-sets")


class WaveletMatrix:
    """A permutation of 0..n-1, for which values in [lo, hi) at places in [l, r) are reported."""

    def __init__(self, values):
        import numpy as np

        self.bits = max(1, int(len(values) - 1).bit_length())
        self.levels = []
        for k in range(self.bits - 1, -1, -1):
            one = (values >> k) & 1 == 1
            self.levels.append((k, np.concatenate([[0], np.cumsum(~one)])))
            values = np.concatenate([values[~one], values[one]])

    def report(self, l, r, lo, hi):
        """For arrays of rectangles: number of the rectangle and value, for each point in one."""
        import numpy as np

        q, base = np.arange(len(l)), np.zeros(len(l), np.int64)
        for k, zeros in self.levels:
            zl, zr, all_zeros = zeros[l], zeros[r], zeros[-1]
            q, base = np.concatenate([q, q]), np.concatenate([base, base + (1 << k)])
            l, r = np.concatenate([zl, all_zeros + l - zl]), np.concatenate([zr, all_zeros + r - zr])
            live = (l < r) & (base < hi[q]) & (base + (1 << k) > lo[q])
            q, base, l, r = q[live], base[live], l[live], r[live]
        return q, base


def _sorted(matrix):
    """Order of the rows of a byte matrix, and what each has in common with the one before it."""
    import numpy as np

    order = np.argsort(np.ascontiguousarray(matrix).view(f"S{matrix.shape[1]}").ravel(), kind="stable")
    rows = matrix[order]
    return order, np.argmax(rows[1:] != rows[:-1], axis=1)


def _intervals(common, length: int, own_before):
    """For each place of an order: the interval of words of the set that share ``length`` letters
    with the word there, in ranks among the words of the set."""
    import numpy as np

    cut = np.flatnonzero(common < length) + 1
    bounds = np.concatenate([[0], cut, [len(common) + 1]])
    size = np.diff(bounds)
    return np.repeat(own_before[bounds[:-1]], size), np.repeat(own_before[bounds[1:]], size)


def near_in_set(words, short, a: int, b: int, cls: int):
    """All near pairs of one set (words of ``cls`` letters and ones of a letter less, distinct) with
    their difference in the places [a, b): arrays of the two places in ``words``, each pair of two
    long words in both directions, of a short and a long one from the short."""
    import numpy as np

    data = np.array([w.encode("latin-1") for w in words], dtype=f"S{cls}").view(np.uint8).reshape(len(words), cls)
    is_short = np.asarray(short)
    back = np.where(is_short[:, None], np.roll(data[:, ::-1], -1, axis=1), data[:, ::-1])
    forward, prefix = _sorted(data)
    reverse, suffix = _sorted(back)
    total = len(words)
    fplace, rplace = np.empty(total, np.int64), np.empty(total, np.int64)
    fplace[forward], rplace[reverse] = np.arange(total), np.arange(total)
    fbefore = np.concatenate([[0], np.cumsum(~is_short[forward])])
    rbefore = np.concatenate([[0], np.cumsum(~is_short[reverse])])
    by_forward, by_reverse = forward[~is_short[forward]], reverse[~is_short[reverse]]
    tree = WaveletMatrix(rbefore[rplace[by_forward]])
    need = np.where(is_short, 1, 2)
    found = []
    for i in range(max(a, cls - 1 - int(suffix.max(initial=0))), min(b, int(prefix.max(initial=0)) + 1)):
        fl, fr = (x[fplace] for x in _intervals(prefix, i, fbefore))
        rl, rr = (x[rplace] for x in _intervals(suffix, cls - 1 - i, rbefore))
        asks = np.flatnonzero((fr - fl >= need) & (rr - rl >= need))
        for at in range(0, len(asks), QUERIES):
            ask = asks[at : at + QUERIES]
            q, value = tree.report(fl[ask], fr[ask], rl[ask], rr[ask])
            q, x = ask[q], by_reverse[value]
            first = True if i == 0 else data[x, i - 1] != data[x, i]
            keep = np.where(is_short[q], first, q != x)
            found.append((q[keep], x[keep]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([q for q, _ in found]), np.concatenate([x for _, x in found])


def _near(table):
    """One task's sets: for each word its near words in them, counted, and the most frequent one."""
    import numpy as np
    import pyarrow as pa

    names, schema = np.array(table["word"].to_pylist(), dtype=object), pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    counts, shorter = table["n"].to_numpy(), np.array(table["short"].to_pylist(), dtype=bool)
    kinds, kind = np.unique(np.array([table[c].to_numpy() for c in ("cls", "a", "b")]), axis=1, return_inverse=True)
    parts = []
    for k, (cls, a, b) in enumerate(kinds.T.tolist()):
        own = np.flatnonzero(kind == k)
        words, n, short = names[own], counts[own], shorter[own]
        if len(own) < 2 or short.all():
            continue
        q, x = near_in_set(words, short, a, b, cls)
        left, right = np.concatenate([q, x[short[q]]]), np.concatenate([x, q[short[q]]])
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(words, kind="stable")] = np.arange(len(words))
        order = np.lexsort([rank[right], -n[right], left])
        left, right = left[order], right[order]
        firsts = np.flatnonzero(np.diff(left, prepend=-1))
        columns = [words[left[firsts]], np.diff(firsts, append=len(left)), n[right[firsts]], words[right[firsts]]]
        parts.append(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema))
    return pa.concat_tables(parts) if parts else schema.empty_table()


def near_words(words: DataFrame, task_rows: int = TASK_ROWS, task_chars: int = TASK_CHARS, **limits: int) -> DataFrame:
    """word, n_near, best (its most frequent near word), best_n; words without a near word have no
    row. ``words``: word (letters up to U+00FF, distinct) and n."""
    dealt = sets(words, **limits)
    size = dealt.agg(F.count(F.lit(1)), F.sum("cls")).first()
    cores = words.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, size[0] // 1000), -(-size[0] // task_rows), -(-(size[1] or 0) // task_chars), 1)
    dealt = dealt.withColumn("task", F.pmod("slot", F.lit(tasks)))
    part = dealt.groupBy("task").applyInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best")))
    return part.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n"))


def with_roots(links: DataFrame) -> DataFrame:
    """word and root from word and form: forms are followed to the last, twice as far each round."""
    roots = shared.stored(links.select("word", F.col("form").alias("root")), "variant-roots", narrow=True)
    for _ in range(ROUNDS):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = shared.stored(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots", narrow=True)
        moved = step.filter("moved").limit(1).count()
        shared.dropped(roots)
        roots = step.drop("moved")
        roots.stored_at = step.stored_at
        if not moved:
            break
    return roots


def spelling_variants(docs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """Every word with n, n_near, its form (the most frequent near word, if ``ratio`` times as
    frequent) with form_n, and its root."""
    shared.prepare(docs.sparkSession)
    words = shared.stored(observed_words(docs), "variant-words", narrow=True)
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    near = shared.stored(near, "variant-near", narrow=True)
    roots = with_roots(near.filter("form is not null"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
