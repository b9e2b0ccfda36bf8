"""Personal data: base patterns, and bootstrapped contexts that find identifiers the patterns miss. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import durable, empty_if_null

# The four base patterns in forms that give the same matches in linear time: possessive repeats, and no start inside
# a run that a match would have begun earlier in.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: A token with a digit or an @ in it: what a context may turn out to be an identifier.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: What is left of a token without outer punctuation.
TRIM = r"^[\p{Punct}&&[^+]]+|\p{Punct}+$"
# Words of four letters and more that tell nothing about what stands beside them (English, German, French, Spanish). Fixed values.
STOP_WORDS = """also been does from have into more only over some such than that their them then there these they this those under very
were what when where which while will with would your aber alle auch dann dass dein denn dich diese doch durch eine einem einen einer
haben hatte ihre kann mehr mein nach nicht noch oder ohne sein sich sind ueber unter viel vom wenn werden wird zwischen avec avoir
bien cette comme dans deux donc elle elles encore entre etre leur mais meme nous pour quand sans sont sous tout tous tres vous como
cuando desde donde ella ellos entre esta este esto hasta mas muy nada otro para pero porque sobre todo todos tras unas unos""".split()
WORDS = 3  # of a context, on either side
SALTS = 16  # that the edges of a pattern are dealt over
SPAN = "array<struct<kind:string,start:int,end:int>>"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def passes(kind: str, m: Column) -> Column:
    """Whether a match of the pattern is one of the kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # up to three digits after leading zeros, and at most 255
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    n = F.length(digits(m))
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), F.call_function("luhn_check", digits(m))).otherwise(False)
    return (n >= 8) & (n <= 15)


def rejected(kind: str, m: Column) -> Column:
    """Whether a match has the shape of the kind and is none: a card number's length without its check digit, a part of an
    address over 255, a phone number of too few or too many digits."""
    n = F.length(digits(m))
    return ~passes(kind, m) & ((n >= 16) & (n <= 19) if kind == "card" else F.lit(kind in ("ip", "phone")))


def matches(text: Column, kind: str | None, pattern: str) -> Column:
    """array<struct<start,end,text>> of all matches, in code points: the texts between matches give the places."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    if kind in NEEDS:
        found = F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(F.array().cast("array<string>"))
    return found


def placed(text: Column, found: Column, pattern: str) -> Column:
    """found with places: struct(found, gaps), gaps the lengths of the texts before each match."""
    gaps = F.when(F.size(found) > 0, F.transform(F.split(text, pattern, -1), lambda s: F.length(s))).otherwise(F.array().cast("array<int>"))
    return F.struct(found.alias("found"), gaps.alias("gaps"))


def steps(found: Column, gaps: Column) -> Column:
    """(start, end, text) of each match, from lengths only; the running place is kept in the fold."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["text"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["text"].alias("text")))).alias("out"))

    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda t, g: F.struct(t.alias("text"), g.alias("gap")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, start, add, lambda acc: acc["out"])).otherwise(start["out"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_hash, base (spans of the base kinds), turned_down (matches that look like a kind and are none) and
    tokens (candidates with their neighbours)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"))
    text = F.col("text")
    rows = rows.select("doc_id", "text", *[matches(text, k, p).alias(f"m_{k}") for k, p in PATTERNS.items()], matches(text, None, CANDIDATE).alias("m_token"))
    # only texts whose matches can pass are split again for places
    rows = rows.withColumn("m_card", F.when(F.exists("m_card", lambda m: F.length(m) >= 16), F.col("m_card")).otherwise(F.array().cast("array<string>")))
    places = [placed(text, F.col(f"m_{k}"), p).alias(f"p_{k}") for k, p in PATTERNS.items()]
    apart = F.when(F.size("m_token") > 0, F.transform(F.split("text", CANDIDATE, -1), ends_of)).otherwise(F.array().cast("array<struct<length:int,first:string,last:string>>"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), *places, "m_token", apart.alias("apart"))
    rows = rows.select("doc_id", "text_hash", F.concat(*[spans_of(k, passes) for k in PATTERNS]).alias("base"), F.concat(*[spans_of(k, rejected) for k in ("card", "ip", "phone")]).alias("turned_down"), "m_token", "apart")
    tokens = steps(F.col("m_token"), F.transform("apart", lambda a: a["length"]))
    return rows.select(
        "doc_id",
        "text_hash",
        "base",
        "turned_down",
        F.zip_with(
            F.zip_with(tokens, F.slice("apart", 1, F.greatest(F.size("m_token"), F.lit(0))), lambda t, a: F.struct(t.alias("t"), a["last"].alias("left"))),
            F.slice("apart", 2, F.greatest(F.size("m_token"), F.lit(0))),
            lambda t, a: F.struct(t["t"]["start"].alias("start"), t["t"]["end"].alias("end"), t["t"]["text"].alias("text"), t["left"].alias("left"), a["first"].alias("right")),
        ).alias("tokens"),
    )


def spans_of(kind: str, test: Callable[[str, Column], Column]) -> Column:
    """The matches of a kind that pass the test, as array<struct<kind,start,end,text>>."""
    kept = F.filter(steps(F.col(f"p_{kind}.found"), F.col(f"p_{kind}.gaps")), lambda m: test(kind, m["text"]))
    return F.transform(kept, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text")))


def ends_of(gap: Column) -> Column:
    """Length, and up to WORDS words next to the candidates on both sides ('' at an edge), of the text between two of them."""
    flat = F.translate(gap, "\n\t\r\x0b\x0c", "     ")
    return F.struct(F.length(gap).alias("length"), F.substring_index(F.ltrim(flat), " ", WORDS).alias("first"), F.substring_index(F.rtrim(flat), " ", -WORDS).alias("last"))


def normal(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, TRIM, ""))


def telling(word: Column) -> Column:
    """Whether a word may be a pattern by itself: four letters or more, and no stop word."""
    return word.rlike(r"\p{L}{4}") & ~word.isin(*STOP_WORDS)


def contexts(left: Column, right: Column, instance: Column) -> Column:
    """The lexical patterns around an instance: one word on both sides, two or three on the left, two on the right, and, with
    the other side open, one word that tells something (see telling) with what kinds of characters the instance has."""
    words = lambda c: F.filter(F.transform(F.split(c, " +"), normal), lambda w: w != "")
    before, after = words(left), words(right)
    kinds = F.concat(*[F.when(instance.rlike(p), F.lit(n)).otherwise(F.lit("")) for n, p in (("a", "[a-z]"), ("9", "[0-9]"), (".", "[^a-z0-9]"))])
    pattern = lambda n, *parts: F.concat_ws(" ", F.lit(n), *parts)
    many = lambda c, n: F.size(c) >= n
    return F.array_compact(
        F.array(
            F.when(many(before, 1) & many(after, 1), pattern("1_1", F.element_at(before, -1), F.get(after, F.lit(0)))),
            F.when(many(before, 2), pattern("2_", *[F.try_element_at(before, F.lit(k)) for k in (-2, -1)])),
            F.when(many(before, 3), pattern("3_", *[F.try_element_at(before, F.lit(k)) for k in (-3, -2, -1)])),
            F.when(many(after, 2), pattern("_2", *[F.get(after, F.lit(k)) for k in (0, 1)])),
            F.when(telling(F.try_element_at(before, F.lit(-1))), pattern("1_*", F.try_element_at(before, F.lit(-1)), kinds)),
            F.when(telling(F.get(after, F.lit(0))), pattern("*_1", F.get(after, F.lit(0)), kinds)),
        )
    )


def with_patterns(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """rows (pattern, instance, ...) with the columns of their pattern; a frequent pattern's rows are dealt over SALTS."""
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("instance"), F.lit(SALTS)).cast("int"))
    copies = patterns.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, ["pattern", "_salt"]).drop("_salt")


def bootstrap(candidates: DataFrame, rounds: int = 3, min_seeds: int = 3, confident: float = 0.8) -> DataFrame:
    """Confident patterns, scored on the graph of patterns and instances.

    candidates has pattern, instance, seed and negative (0/1). A negative instance has score 0 for good. A pattern's score is the mean score of its distinct instances, held
    back by one instance that counts as wrong; an instance is as good as its best pattern that at least min_seeds
    distinct seeds support, seeds are 1. Equal pairs are counted once before any shuffle of pairs, so a frequent context
    costs its distinct instances only.
    """
    edges = durable(candidates.where("instance <> ''").groupBy("pattern", "instance").agg(F.max("seed").cast("double").alias("seed"), F.max("negative").alias("negative")).select("pattern", "instance", "negative", F.when(F.col("negative") == 1, 0.0).otherwise(F.col("seed")).alias("score")), "edges")
    score = edges
    supported = None
    for _ in range(rounds):
        supported = durable(
            score.groupBy("pattern")
            .agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("pattern_score"), F.sum(F.when(F.col("score") >= 1, 1).otherwise(0)).alias("seeds"))
            .where(F.col("seeds") >= min_seeds),
            "patterns",
        )
        best = with_patterns(edges, supported).groupBy("instance").agg(F.max("pattern_score").alias("best"))
        score = durable(edges.join(best, "instance", "left").select("pattern", "instance", "negative", F.when(F.col("negative") == 1, 0.0).otherwise(F.greatest("score", F.coalesce("best", F.lit(0.0)))).alias("score")), "scores")
    return supported.where(F.col("pattern_score") >= confident).select("pattern", "pattern_score")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, min_seeds: int = 3, confident: float = 0.8) -> DataFrame:
    """One row per row of docs: doc_id, text_hash (xxhash64), base and learned, arrays of struct(kind, start, end[, text]) in code points, end exclusive.

    Null texts count as empty and have no spans; a null doc_id stays null; rows that are equal in id and text come
    back as often as they were given. Kind `context` marks a token that a confident pattern (see contexts) surrounds and that
    touches neither a base span nor a match that a base kind has turned down; those count against the patterns around them. Other columns of docs are not looked at.
    """
    rows = durable(scan(docs, id_col, text_col), "scan")
    tokens = rows.select("doc_id", "text_hash", "base", "turned_down", F.explode("tokens").alias("t"))
    touching = lambda spans: F.exists(spans, lambda b: (b["start"] < F.col("t.end")) & (b["end"] > F.col("t.start"))).cast("int")
    candidates = tokens.select(
        "doc_id", "text_hash", F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.col("t.left").alias("left"), F.col("t.right").alias("right"), normal(F.col("t.text")).alias("instance"), touching("base").alias("seed"), touching("turned_down").alias("negative")
    ).withColumn("negative", F.col("negative") * (1 - F.col("seed")))
    around = candidates.select("doc_id", "text_hash", "start", "end", "instance", "seed", "negative", F.explode(contexts(F.col("left"), F.col("right"), F.col("instance"))).alias("pattern"))
    around = durable(around, "candidates")
    patterns = bootstrap(around, rounds, min_seeds, confident)
    found = (
        with_patterns(around.where("seed = 0 and negative = 0 and instance <> ''"), patterns)
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.array_sort(F.collect_set(F.struct(F.lit("context").alias("kind"), "start", "end"))).alias("learned"))
    )
    joined = rows.join(found, rows.doc_id.eqNullSafe(found._id) & (rows.text_hash == found._hash), "left")
    return joined.select("doc_id", "text_hash", "base", F.coalesce("learned", F.array().cast(SPAN)).alias("learned"))


def redact(text: Column, spans: Column) -> Column:
    """text with each span (struct kind, start, end) replaced by [KIND]; where spans overlap, the first one's mark stands."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(
            s["start"] >= acc["at"], F.struct((-s["less"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))
        ).otherwise(F.struct(F.greatest(acc["at"], -s["less"]).alias("at"), acc["out"].alias("out")))

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(ordered, begin, add, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    )
