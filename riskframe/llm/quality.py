"""Quality rules as weak supervision, in DataFrame and SQL expressions only.

Each rule looks at one measure of a text and votes good (1), bad (-1) or
abstains (0). The vote patterns of all documents are counted (at most 3^rules
rows, whatever the corpus), and expectation-maximisation over those counts
estimates how many documents are good and, per rule, how often its vote is right
for good and for bad documents. The whole iteration is one SQL expression over
one row. A document's posterior probability of being good replaces the usual
demand that every rule pass.

Measures (contract): words are runs of anything but the ASCII white space
`[\\x20\\x09-\\x0D]`; word_chars, n_symbols (`#*$%&|<>`), n_dup_lines (lines with
a word equal to an earlier line) and n_repeat_words (words inside 3-word windows
that occur twice or more). Equal windows are found by sorting their 64-bit
hashes within the row: two different windows of one text of n words are confused
with a probability below n^2 / 2^65. A long text costs O(n log n).

`base_failed` documents (under 50 words, or over half of the words repeated) are
never kept and do not take part in the estimate.

Defined results: a null or empty text has no words and fails; ties and repeated
rows are judged alike; an empty table gives an empty result; extra columns are
ignored, and clashing names are safe: those of the caller that start like working
columns get other names meanwhile.
"""
from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import own_names, written

MIN_WORDS = 50
KEEP_AT = 0.5          # posterior probability of being good from which a document is kept
EM_ROUNDS = 40
#: Ends of the search for accuracies: a rule is neither perfect nor worse than a coin by much.
FLOOR = 0.0005

_WS = r"[\\x20\\x09-\\x0D]"

#: SQL of one measure row from column __q_t (text, never null); lambdas bind each array once.
_MEASURES = rf"""
transform(array(if(trim(both ' \t\n\u000B\u000C\r' from __q_t) = '', cast(array() as array<string>),
                   split(trim(both ' \t\n\u000B\u000C\r' from __q_t), '{_WS}+'))), w ->
  named_struct(
    'n_words', cast(size(w) as bigint),
    'n_distinct', cast(size(array_distinct(w)) as bigint),
    'n_repeat_words', if(size(w) < 3, 0L,
      transform(array(sort_array(transform(sequence(0, size(w) - 3),
                 i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) as h, i as p)))), g ->
        transform(array(sort_array(transform(filter(sequence(0, size(g) - 1),
                     k -> (k > 0 and g[k].h = g[greatest(k - 1, 0)].h)
                       or (k < size(g) - 1 and g[k].h = g[least(k + 1, size(g) - 1)].h)), k -> g[k].p))), p ->
          aggregate(sequence(1, size(p)), 0L,
                    (a, k) -> if(size(p) = 0, a, a + if(k >= size(p), 3L, cast(least(3, p[least(k, size(p) - 1)] - p[least(k, size(p)) - 1]) as bigint))))
        )[0])[0])
  ))[0]
"""

_LINES = rf"""
transform(array(filter(split(__q_t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')), l ->
  named_struct('n_lines', cast(size(l) as bigint), 'n_distinct_lines', cast(size(array_distinct(l)) as bigint),
               'n_ended', cast(size(filter(l, x -> x rlike '[.?!"\u201D)]{_WS}*$')) as bigint)))[0]
"""

#: ASCII punctuation as SQL text.
_PUNCT = string.punctuation.replace("\\", "\\\\").replace("'", "\\'")

#: name, bad when, good when (neither: abstains)
RULES = (
    ("symbols", "n_symbols > 0.1 * n_words", "n_symbols < 0.03 * n_words"),
    ("punctuation", "n_punct > 0.1 * word_chars", "n_punct < 0.07 * word_chars"),
    ("capitals", "n_upper > 0.4 * n_letters", "n_upper < 0.15 * n_letters"),
    ("exclaims", "n_marks > 0.15 * n_words", "n_marks < 0.05 * n_words"),
    ("lines_repeat", "n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0"),
    ("words_repeat", "n_repeat_words > 0.3 * n_words", "n_repeat_words < 0.2 * n_words"),
    ("word_length", "word_chars < 2.5 * n_words or word_chars > 14 * n_words", "word_chars between 3 * n_words and 11 * n_words"),
    ("vocabulary", "n_distinct < 0.1 * n_words", "n_distinct > 0.25 * n_words"),
)


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` plus one struct column `__q_m` of measures."""
    d = docs.withColumn("__q_t", F.coalesce(F.col(text), F.lit("")))
    d = d.withColumn("__q_w", F.expr(_MEASURES)).withColumn("__q_l", F.expr(_LINES))
    m = {
        "n_words": "__q_w.n_words", "n_distinct": "__q_w.n_distinct", "n_repeat_words": "__q_w.n_repeat_words",
        "n_lines": "__q_l.n_lines", "n_dup_lines": "__q_l.n_lines - __q_l.n_distinct_lines",
        "word_chars": r"cast(length(translate(__q_t, ' \t\n\u000B\u000C\r', '')) as bigint)",
        "n_symbols": "cast(length(__q_t) - length(translate(__q_t, '#*$%&|<>', '')) as bigint)",
        "n_marks": "cast(length(__q_t) - length(translate(__q_t, '!?', '')) as bigint)",
        "n_punct": f"cast(length(__q_t) - length(translate(__q_t, '{_PUNCT}', '')) as bigint)",
        "n_upper": "cast(length(__q_t) - length(translate(__q_t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) as bigint)",
        "n_letters": "cast(length(__q_t) - length(translate(__q_t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', '')) as bigint)",
    }
    return (d.withColumn("__q_m", F.expr("named_struct(" + ", ".join(f"'{k}', {v}" for k, v in m.items()) + ")"))
            .drop("__q_t", "__q_w", "__q_l"))


BASE_FAILED = f"(n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words)"


def _on(m: str, sql: str) -> str:
    """A condition on measure names as one on the fields of struct `m`."""
    return re.sub(r"\b(n_\w+|word_chars)\b", rf"{m}.\1", sql)


def with_votes(measured: DataFrame) -> DataFrame:
    """Add `__q_bad` (base_failed) and `__q_v`, the votes as an array of -1, 0 and 1."""
    votes = ", ".join(f"case when {_on('__q_m', bad)} then -1 when {_on('__q_m', good)} then 1 else 0 end" for _, bad, good in RULES)
    return (measured.withColumn("__q_bad", F.expr(_on("__q_m", BASE_FAILED)))
            .withColumn("__q_v", F.expr(f"array({votes})")))


def _em_sql(rules: int, rounds: int) -> str:
    """SQL for the estimate from column `pats`: array<struct<n: bigint, v: array<int>>>.

    State: share of good documents, ag[j] = P(vote good | good, voted) and
    ab[j] = P(vote bad | bad, voted). The start trusts any bad vote.
    """
    e_step = """transform(pats, x -> 1D / (1D + exp(-(ln(st.share / (1D - st.share)) + aggregate(sequence(0, {k}), 0D,
        (a, j) -> a + case when x.v[j] = 1 then ln(st.ag[j] / (1D - st.ab[j]))
                           when x.v[j] = -1 then ln((1D - st.ag[j]) / st.ab[j]) else 0D end)))))"""
    m_step = """transform(array({q}), q -> named_struct(
      'share', least(greatest(aggregate(sequence(0, size(pats) - 1), 0D, (a, i) -> a + pats[i].n * q[i])
                              / aggregate(pats, 0D, (a, x) -> a + x.n), {f}D), 1D - {f}D),
      'ag', transform(sequence(0, {k}), j -> least(greatest(
          (1D + aggregate(sequence(0, size(pats) - 1), 0D, (a, i) -> a + if(pats[i].v[j] = 1, pats[i].n * q[i], 0D)))
          / (2D + aggregate(sequence(0, size(pats) - 1), 0D, (a, i) -> a + if(pats[i].v[j] != 0, pats[i].n * q[i], 0D))), {f}D), 1D - {f}D)),
      'ab', transform(sequence(0, {k}), j -> least(greatest(
          (1D + aggregate(sequence(0, size(pats) - 1), 0D, (a, i) -> a + if(pats[i].v[j] = -1, pats[i].n * (1D - q[i]), 0D)))
          / (2D + aggregate(sequence(0, size(pats) - 1), 0D, (a, i) -> a + if(pats[i].v[j] != 0, pats[i].n * (1D - q[i]), 0D))), {f}D), 1D - {f}D))))[0]"""
    k = rules - 1
    first = "transform(pats, x -> if(array_contains(x.v, -1), 0.05D, 0.95D))"
    step = m_step.format(q=e_step.format(k=k), k=k, f=FLOOR)
    start = m_step.format(q=first, k=k, f=FLOOR)
    return f"aggregate(sequence(1, {rounds}), {start}, (st, r) -> {step})"


def estimate(voted: DataFrame, rounds: int = EM_ROUNDS) -> DataFrame:
    """One row: column `__q_st` with the share of good documents and each rule's accuracies.

    The counted patterns number at most 3^rules, so the single row is bounded.
    Without any document the row is null and nobody needs it.
    """
    pats = (voted.where("not __q_bad").groupBy("__q_v").agg(F.count("*").alias("n"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("n"), F.col("__q_v").alias("v")))).alias("pats")))
    return pats.select(F.expr(f"if(size(pats) = 0, null, {_em_sql(len(RULES), rounds)})").alias("__q_st"))


def with_posterior(voted: DataFrame, state: DataFrame) -> DataFrame:
    """Add `__q_p`, the posterior probability of good; `state` is one row."""
    log_odds = "ln(__q_st.share / (1D - __q_st.share))" + "".join(
        f" + case when __q_v[{j}] = 1 then ln(__q_st.ag[{j}] / (1D - __q_st.ab[{j}]))"
        f" when __q_v[{j}] = -1 then ln((1D - __q_st.ag[{j}]) / __q_st.ab[{j}]) else 0D end" for j in range(len(RULES)))
    return (voted.crossJoin(F.broadcast(state))
            .withColumn("__q_p", F.expr(f"1D / (1D + exp(-({log_odds})))")).drop("__q_st"))


KEPT = f"not __q_bad and coalesce(__q_p >= {KEEP_AT}, false)"


def score_documents(docs: DataFrame) -> DataFrame:
    """Contract columns, the votes and the posterior of every document."""
    voted = written(with_votes(with_measures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))).drop("text"), "quality")
    return with_posterior(voted, estimate(voted)).select(
        "doc_id", *(F.col(f"__q_m.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.col("__q_bad").alias("base_failed"), F.expr(KEPT).alias("kept"),
        F.round("__q_p", 6).alias("posterior"), F.expr("concat_ws(',', transform(__q_v, x -> cast(x as string)))").alias("votes"))


@own_names
def keep_good(docs: DataFrame) -> DataFrame:
    """`docs` without rejected rows; columns as they were.

    Every text is measured once: rows are written with their votes, the estimate
    reads the votes alone, and the filter reads the rows. Texts are never shuffled.
    """
    voted = written(with_votes(with_measures(docs)).drop("__q_m"), "quality-rows")
    state = written(estimate(voted), "quality-state")
    return with_posterior(voted, state).where(F.expr(KEPT)).select(*docs.columns)
