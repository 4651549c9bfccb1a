"""Personal data in texts: fixed patterns, and what bootstrapped contexts add to them.

The base matches of four kinds are seeds. The words before them are lexical patterns. Patterns and the instances that follow
them form a graph, which is scored in rounds: a pattern's confidence for a kind is the mean confidence of its instances, and
an instance that looks like the kind gets the best confidence of its patterns. Words with digits or an `@`, and groups of
digits joined by single spaces, dots, brackets or hyphens, that follow confident patterns, and that the base rules miss, are
thus found. A word inside such groups is found only if they are not.

Everything is an expression of the DataFrame. Quantifiers are possessive and starts are anchored, so that no text makes a
pattern backtrack; the matches are those of the plain patterns in `KINDS`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstrata.llm.common import one_if_small, stage

#: Kinds in their order, with the plain patterns. Fixed values.
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The same matches without backtracking. A match may start inside a run of characters only where the last one ended.
_FAST = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": KINDS["phone"],
}
#: A word with a digit or an `@`.
_WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Groups of digits joined by single spaces, dots, brackets or hyphens, from the first group on, each at the end of a word or joint.
_GROUPS = (
    r"(?<![^\x20\x09-\x0D])\(?+[0-9]++"
    r"(?:[).-]?+\x20?+[(.-]?+[0-9]++(?![^\x20\x09-\x0D.,;:!?()\]\x22\x27-]))++"
)
#: Characters before a match in which its context is looked for.
LEFT = 64
#: Rounds; the confidence from which patterns and instances count; distinct instances that a pattern needs.
ROUNDS, CONFIDENT, SUPPORT = 3, 0.8, 3
_CHUNK = 256


def _sums_before(numbers: str) -> str:
    """For each number of an array the sum of those before it. Sums grow in chunks, so long arrays take no square time."""
    grow = "aggregate({0}, array(0L), (a, x) -> concat(a, array(element_at(a, -1) + x)))"
    chunks = f"transform(sequence(0, cast((size({numbers}) - 1) div {_CHUNK} as int)), c -> slice({numbers}, c * {_CHUNK} + 1, {_CHUNK}))"
    inside = f"transform({chunks}, ch -> {grow.format('ch')})"
    return (
        f"flatten(element_at(transform(array({inside}), w -> zip_with(slice("
        f"{grow.format('transform(w, s -> element_at(s, -1))')}, 1, size(w)), w,"
        " (before, s) -> transform(slice(s, 1, size(s) - 1), x -> before + x))), 1))"
    )


def _matches(text: str, pattern: str) -> str:
    """`first`, `stop` (code points, end exclusive), `value` and `before` (text after the last match) of all matches."""
    quoted = pattern.replace("\\", "\\\\")
    numbers = "zip_with(x.gaps, x.values, (g, v) -> cast(length(g) + length(v) as bigint))"
    found = f"""element_at(transform(array(named_struct('values', values, 'gaps', slice(split({text}, '{quoted}', -1), 1, size(values)))), x ->
      zip_with(arrays_zip(x.gaps, x.values), {_sums_before(numbers)}, (m, at) -> named_struct(
        'first', at + length(m.gaps), 'stop', at + length(m.gaps) + length(m.values), 'value', m.values,
        'before', right(m.gaps, {LEFT})))), 1)"""
    kind = "array<struct<first: bigint, stop: bigint, value: string, before: string>>"
    return (
        f"element_at(transform(array(regexp_extract_all({text}, '{quoted}', 0)), values ->"
        f" if(size(values) = 0, cast(array() as {kind}), {found})), 1)"
    )


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    double = "if(i % 2 = 0, int(c), if(int(c) < 5, 2 * int(c), 2 * int(c) - 9))"
    return f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> {double}), 0, (s, x) -> s + x) % 10 = 0"


_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)"
_VALID = {
    "email": "true",
    "ip": rf"m.value rlike '^{_PART}\\.{_PART}\\.{_PART}\\.{_PART}$'",
    "card": f"length({_digits('m.value')}) between 14 and 19 and {_luhn(_digits('m.value'))}",
    "phone": f"length({_digits('m.value')}) between 10 and 15",
}
#: A text without this can hold no match of the kind.
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: What a word must look like to be found as a kind.
_LOOKS = {
    "email": "value rlike '^[^@]+@[^@]+$'",
    "ip": r"value rlike '^[0-9a-fA-F]*[:.][0-9a-fA-F:.]+$' and length(regexp_replace(value, '[^0-9]', '')) >= 4",
    "card": "length(regexp_replace(value, '[^0-9]', '')) between 12 and 19 and value rlike '^[0-9 .-]+$'",
    "phone": r"length(regexp_replace(value, '[^0-9]', '')) between 7 and 15 and value rlike '^[0-9 ()./-]+$'",
}


def base_spans(documents: DataFrame) -> DataFrame:
    """`row`, `doc_id`, `base` and `words`: spans of the base rules, and words that they miss, with what stands before."""
    rows = documents.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = {
        kind: F.expr(f"filter({_matches('text', pattern)}, m -> {_VALID[kind]})" if not _NEEDS[kind] else
                     f"if(contains(text, '{_NEEDS[kind]}'), filter({_matches('text', pattern)}, m -> {_VALID[kind]}), array())")
        for kind, pattern in _FAST.items()
    }
    rows = rows.withColumns({**found, "words": F.expr(_matches("text", _WORD)), "groups": F.expr(_matches("text", _GROUPS))})
    tagged = [
        f"transform({kind}, m -> named_struct('first', m.first, 'kind_no', {i}, 'stop', m.stop, 'value', m.value, 'before', m.before))"
        for i, kind in enumerate(KINDS)
    ]
    apart = "not exists(base, b -> b.first < w.stop and w.first < b.stop)"
    like = f"(w.value like '%@%' or length({_digits('w.value')}) >= 4)"
    return (
        rows.withColumn("base", F.expr(f"array_sort(concat({', '.join(tagged)}))"))
        .select(
            "row", "doc_id", "base",
            F.expr(f"concat(filter(words, w -> {like} and {apart}), filter(groups, w -> w.value like '% %' and {like} and {apart}))").alias("words"),
        )
    )


def _patterns(before: str) -> str:
    """The last word before a match, and the last two, in lower case."""
    one = f"lower(regexp_extract({before}, '([^\\\\x20\\\\x09-\\\\x0D]+)[\\\\x20\\\\x09-\\\\x0D]*$', 1))"
    two = f"lower(regexp_extract({before}, '([^\\\\x20\\\\x09-\\\\x0D]+[\\\\x20\\\\x09-\\\\x0D]+[^\\\\x20\\\\x09-\\\\x0D]+)[\\\\x20\\\\x09-\\\\x0D]*$', 1))"
    return f"filter(array({one}, {two}), p -> p <> '')"


def _instance(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, r"[.,;:!?)\]\"']+$", ""))


def found_in_context(spans: DataFrame) -> DataFrame:
    """`row`, `kind_no`, `first`, `stop` of words that confident patterns find, from `base_spans`, staged."""
    seeds = spans.select("row", F.explode("base").alias("m")).select("row", "m.kind_no", "m.first", "m.stop", "m.value", "m.before")
    words = spans.select("row", F.explode("words").alias("m")).select("row", F.lit(None).cast("int").alias("kind_no"), "m.*")
    looks = F.expr("filter(array(" + ", ".join(f"if({test}, {i}, -1)" for i, test in enumerate(_LOOKS.values())) + "), k -> k >= 0)")
    words = words.withColumn("value", F.regexp_replace("value", r"[.,;:!?)\]\"']+$", "")).withColumn("looks", looks)
    words = words.filter(F.size("looks") > 0)
    seeds = seeds.withColumn("looks", F.array("kind_no"))
    mentions = seeds.unionByName(words).withColumn("instance", _instance(F.col("value")))
    edges = mentions.select("instance", "looks", "kind_no", F.explode(F.expr(_patterns("before"))).alias("pattern"))
    # A value is a seed or a word, in one pattern or many: one edge each.
    edges = edges.groupBy("pattern", "instance").agg(F.max("kind_no").alias("kind_no"), F.max("looks").alias("looks"))
    edges = stage(edges, "contexts")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    seeded = edges.filter("kind_no is not null").select("instance", F.col("kind_no").alias("kind"), F.lit(1.0).alias("score")).distinct()
    scores, before = stage(seeded, "scores"), -1
    learnt = None
    for _ in range(ROUNDS):
        sums = edges.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("sum"))
        good = sums.filter(F.col("sum") >= SUPPORT).join(sizes, "pattern").withColumn("score", F.col("sum") / F.col("n"))
        good = one_if_small(stage(good.filter(F.col("score") >= CONFIDENT).select("pattern", "kind", "score"), "patterns"))
        learnt = edges.filter("kind_no is null").join(good, "pattern").filter("array_contains(looks, kind)")
        learnt = learnt.groupBy("instance", "kind").agg(F.max("score").alias("score"))
        learnt = stage(learnt.join(seeded.select("instance"), "instance", "left_anti"), "learnt")
        n = learnt.count()
        if n == before:
            break
        before = n
        scores = seeded.union(learnt)
    chosen = learnt.groupBy("instance").agg(F.min_by("kind", F.struct(-F.col("score"), "kind")).alias("kind_no"))
    words = words.drop("kind_no").withColumn("instance", _instance(F.col("value")))
    found = words.join(one_if_small(stage(chosen, "found")), "instance")
    return found.select("row", "kind_no", "first", (F.col("first") + F.length("value")).alias("stop"))


def _text_of(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat(get(array({names}), s.kind_no), ':', s.first, ':', s.stop)), ',')"


def find(documents: DataFrame) -> DataFrame:
    """`doc_id`, `n_email`, `n_ip`, `n_card`, `n_phone`, `base` and `spans` for every row of `documents` (`doc_id`, `text`).

    `base` has the spans of the base rules as `kind:start:end`, by start and kind, joined by commas, and the numbers count
    them; `spans` has those of the method too. Places are code points. A null text is an empty one. Repeated rows stay, and
    so do base spans of different kinds that overlap; what the method adds overlaps none.
    """
    spans = stage(base_spans(documents), "spans")
    more = found_in_context(spans).distinct()
    earlier = Window.partitionBy("row").orderBy("first", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    more = more.withColumn("upto", F.max("stop").over(earlier)).filter("upto is null or upto <= first").drop("upto")
    more = more.groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct("first", "kind_no", "stop")).alias("more"))
    base = "transform(base, s -> named_struct('first', s.first, 'kind_no', s.kind_no, 'stop', s.stop))"
    rows = spans.select("row", "doc_id", F.expr(base).alias("base"))
    rows = rows.join(one_if_small(stage(more, "more"), 100_000), F.col("row") == F.col("r"), "left")
    both = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    rows = rows.withColumn("all", both)
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind_no = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.expr(_text_of("base")).alias("base"), F.expr(_text_of("all")).alias("spans"))
