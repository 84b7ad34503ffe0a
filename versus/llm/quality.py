"""Quality rules: how far a document's distributions lie from those of its language.

Two histograms are made of each document: of character classes, and of the common words of its
language (all other words in one bin): a given list, or for languages without one the ``BINS`` words
that are most frequent in all their documents. References are the sums of both over all documents
of a value of ``lang``; documents with a null or empty value are one language. A document is dropped
if the Jensen-Shannon distance (base 2) of either histogram to its reference exceeds a threshold. A
histogram of fewer than ``MIN_CHARS`` characters or ``MIN_WORDS`` words is not judged, and a
reference of fewer than ``MIN_DOCUMENTS`` documents does not judge.

Everything is built from DataFrame functions: repeated eight-word windows are found by hashing
words, then pairs, fours and eights of them, and sorting the hashes of those rows that have equal
ones. Only the features are stored and summed; word lists and references, one row a language, are
looked up, which broadcasts them only after counting their rows and bytes.

Null text counts as empty, without words: it fails the base rule. Each row is judged by itself,
repeated rows alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from versus.llm.common import table
from versus.operators.lookup import lookup
from versus.session import materialize

MIN_CHARS = 200
MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.33
MIN_DOCUMENTS = 20

# Character classes as the insides of regular expression classes; the rest of the
# characters is one more class.
CLASSES = ["aeiou", "b-df-hj-np-tv-z", "A-Z", "0-9", r"\x20\x09-\x0D", r".,;:!?'\x22()-", r"\x{80}-\x{10FFFF}"]

# Frequent words of languages.
COMMON = {
    "de": "der die und das den von zu mit sich des ist im ein nicht auf".split(),
    "en": "the of and to in a is that for it was on are as with".split(),
    "es": "de la que el en y a los se del las un por con para".split(),
    "fr": "le la de et les des que est en du un pour dans qui une".split(),
}
BINS = 15


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(words: Column) -> Column:
    """Words that lie in an eight-word window found twice or more."""

    def doubled(hashes: Column, step: int, use: Callable[[Column], Column]) -> Column:
        return let(F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + step))), use)

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            same = F.transform(
                s,
                lambda x, i: F.struct(
                    x["i"].alias("i"),
                    (
                        F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                        | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))
                    ).alias("twice"),
                ),
            )
            places = F.sort_array(F.transform(F.filter(same, lambda x: x["twice"]), lambda x: x["i"]))
            return let(
                places,
                lambda p: F.aggregate(
                    F.transform(p, lambda x, i: F.least(F.lit(8), F.coalesce(F.get(p, i + 1) - x, F.lit(8)))),
                    F.lit(0),
                    lambda a, b: a + b,
                ),
            )

        return let(placed, marked)

    def count(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            covered(windows)
        )

    eights = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda a: doubled(
            a, 1, lambda b: doubled(
                b, 2, lambda c: doubled(c, 4, lambda d: let(F.slice(d, 1, F.size(d) - 7), count))
            ),
        ),
    )
    return F.when(F.size(words) < 8, F.lit(0)).otherwise(eights)


def _words() -> Column:
    return F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")


def common_words(texts: DataFrame) -> DataFrame:
    """ref and the most frequent words of each language without a list; ties by the word."""
    counts = (
        texts.where(~F.col("ref").isin(list(COMMON)))
        .select("ref", F.explode(_words()).alias("word"))
        .groupBy("ref", "word").agg(F.count("*").alias("n"))
    )
    order = Window.partitionBy("ref").orderBy(F.desc("n"), "word")
    first = counts.withColumn("at", F.row_number().over(order)).where(F.col("at") <= BINS)
    places = F.sort_array(F.collect_list(F.struct("at", "word")))
    return first.groupBy("ref").agg(F.transform(places, lambda x: x["word"]).alias("corpus"))


def features(docs: DataFrame) -> DataFrame:
    """doc_id, ref, the base numbers, and the histograms ``classes`` and ``common``."""
    by_language = F.create_map(
        *(x for lang, list_ in COMMON.items() for x in (F.lit(lang), F.array(*map(F.lit, list_))))
    )
    texts = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("ref"), F.coalesce("text", F.lit("")).alias("text")
    )
    all_common = sorted({w for list_ in COMMON.values() for w in list_})
    split = lookup(texts, materialize(common_words(texts)), ["ref"], "left").select(
        "doc_id",
        "ref",
        "text",
        _words().alias("words"),
        F.coalesce(F.col("corpus"), F.array().cast("array<string>")).alias("corpus"),
    )
    # a language of few different words has empty bins
    listed = F.coalesce(
        F.element_at(by_language, F.col("ref")),
        F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.get(F.col("corpus"), i)),
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def length_without(inside: str) -> Column:
        return F.length(F.regexp_replace("text", f"[{inside}]+", ""))

    return split.select(
        "doc_id",
        "ref",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.length("text").cast("long").alias("n_chars"),
        F.array(*((F.length("text") - length_without(c)).cast("long") for c in CLASSES)).alias("classes"),
        let(
            F.filter("words", lambda w: w.isin(all_common) | F.array_contains("corpus", w)),
            lambda found: F.transform(
                listed, lambda c: F.size(F.filter(found, lambda w: w == c)).cast("long")
            ),
        ).alias("common"),
    )


def _with_rest(histogram: Column, total: Column) -> Column:
    """The histogram with one more bin for the rest, as shares."""
    known = F.aggregate(histogram, F.lit(0).cast("long"), lambda a, b: a + b)
    return F.transform(
        F.concat(histogram, F.array(total - known)), lambda x: x / F.greatest(total, F.lit(1))
    )


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, with logarithms to base 2."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def judge(docs: DataFrame) -> DataFrame:
    """The base numbers, base_failed, both distances and kept of every row."""
    found = materialize(features(docs))
    parts = {"classes": len(CLASSES), "common": BINS}
    sums = [
        F.array(*(F.sum(F.get(F.col(c), F.lit(i))) for i in range(n))).alias(f"all_{c}")
        for c, n in parts.items()
    ]
    sums += [F.sum("n_chars").alias("all_chars"), F.sum("n_words").alias("all_words"), F.count("*").alias("n")]
    references = found.groupBy("ref").agg(*sums).select(
        "ref",
        F.col("n").alias("ref_documents"),
        _with_rest(F.col("all_classes"), F.col("all_chars")).alias("ref_classes"),
        _with_rest(F.col("all_common"), F.col("all_words")).alias("ref_common"),
    )
    measured = lookup(found, materialize(references), ["ref"], "left").select(
        "*",
        distance(_with_rest(F.col("classes"), F.col("n_chars")), F.col("ref_classes")).alias("class_distance"),
        distance(_with_rest(F.col("common"), F.col("n_words")), F.col("ref_common")).alias("word_distance"),
    )
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    far = ((F.col("n_chars") >= MIN_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)) | (
        (F.col("n_words") >= MIN_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE)
    )
    far = far & (F.col("ref_documents") >= MIN_DOCUMENTS)
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & ~far).alias("kept"),
        "n_chars", "class_distance", "word_distance",
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("n_chars", "class_distance", "word_distance")


def _quoted(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _oracle() -> str:
    lists = " ".join(f"WHEN '{lang}' THEN {_quoted(words)}" for lang, words in COMMON.items())
    listed = _quoted(list(COMMON))[1:-1]
    classes = ", ".join(
        "length(text) - length(regexp_replace(text, '[" + c.replace("'", "''") + "]+', '', 'g'))"
        for c in CLASSES
    )

    def far(p: str, q: str) -> str:
        def part(x: str, y: str) -> str:
            return f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0.0 END"

        terms = f"lambda i: {part(f'{p}[i]', f'{q}[i]')} + {part(f'{q}[i]', f'{p}[i]')}"
        return f"sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), {terms})) / 2, 0))"

    def shares(h: str, total: str) -> str:
        return (
            f"list_transform(list_append({h}, {total} - list_sum({h})), "
            f"lambda x: x / greatest({total}, 1)::DOUBLE)"
        )

    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS ref, coalesce(text, '') AS text FROM documents),
v AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
often AS (SELECT ref, list(x ORDER BY n DESC, x) AS c FROM (
  SELECT ref, x, n, row_number() OVER (PARTITION BY ref ORDER BY n DESC, x) AS place FROM (
    SELECT ref, x, count(*) AS n FROM (SELECT ref, unnest(w) AS x FROM v WHERE ref NOT IN ({listed})) GROUP BY ref, x))
  WHERE place <= {BINS} GROUP BY ref),
w AS (SELECT v.*, CASE ref {lists} ELSE list_transform(range(1, {BINS + 1}), lambda i: often.c[i]) END AS c
  FROM v LEFT JOIN often USING (ref)),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1),
cover AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(8) AS t(j) GROUP BY doc_id),
f AS (SELECT w.doc_id, ref, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
  length(text)::BIGINT AS n_chars, [{classes}] AS classes,
  list_transform(c, lambda v: len(list_filter(w, lambda x: x = v))) AS common
  FROM w LEFT JOIN cover USING (doc_id)),
sum_classes AS (SELECT ref, list(s ORDER BY i) AS h FROM (SELECT ref, i, sum(classes[i]) AS s
  FROM f, range(1, {len(CLASSES) + 1}) AS t(i) GROUP BY ref, i) GROUP BY ref),
sum_common AS (SELECT ref, list(s ORDER BY i) AS h FROM (SELECT ref, i, sum(common[i]) AS s
  FROM f, range(1, {BINS + 1}) AS t(i) GROUP BY ref, i) GROUP BY ref),
total AS (SELECT ref, sum(n_chars) AS chars, sum(n_words) AS words, count(*) AS n FROM f GROUP BY ref),
refs AS (SELECT ref, n, {shares('a.h', 'chars')} AS qc, {shares('b.h', 'words')} AS qw
  FROM total JOIN sum_classes a USING (ref) JOIN sum_common b USING (ref)),
p AS (SELECT f.*, n, qc, qw, {shares('classes', 'n_chars')} AS pc, {shares('common', 'n_words')} AS pw
  FROM f JOIN refs USING (ref)),
m AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  {far('pc', 'qc')} AS dc, {far('pw', 'qw')} AS dw FROM p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n >= {MIN_DOCUMENTS} AND ((n_chars >= {MIN_CHARS} AND dc > {MAX_CLASS_DISTANCE})
    OR (n_words >= {MIN_WORDS} AND dw > {MAX_WORD_DISTANCE}))) AS kept
FROM m"""


ORACLE = {"op7_quality": _oracle()}
