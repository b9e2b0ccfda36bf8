"""Secrets: base patterns, and values in the context of credentials that would take many guesses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import bound_batches, empty_if_null

BASE = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
#: Words that announce a credential, by themselves or behind a small letter as in dbPassword, and what may stand between them and the value.
CONTEXT = re.compile(
    r"""(?:(?<![A-Za-z])|(?-i:(?<=[a-z])(?=[A-Z])))(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_\x20-]?key|access[_\x20-]?key|private[_\x20-]?key|client[_\x20-]?secret|credentials?|authorization|bearer|login|pin)"""
    r"""(?![A-Za-z])["']?(?:(?P<sign>[\x20\t]*(?:[:=]=?|=>|->)[\x20\t]*)|[\x20\t]+(?:is|was)[\x20\t]+)(?:bearer[\x20\t]+|basic[\x20\t]+)?(?P<value>"[^"\n]+"|'[^'\n]+'|[^\s"'<>,;]+)""",
    re.I | re.A,
)
GUESSES = 8.0  # log10; a value that takes more is taken for a secret
MOST_WORDS = 200_000  # of the corpus, that count as words
LONGEST_WORD = 40
PERIODS = 8  # of repeats inside a value; a repeat that is the whole value may have any
HELD_WORDS = 200_000  # counted in a task before they are handed on
CUT = math.log10(2)  # that a known span costs besides its own guesses

# Usual words of passwords and their neighbours, by rank, and keyboard rows. Words of the corpus come behind.
WORDS = """password admin welcome login master dragon monkey letmein qwerty football baseball shadow sunshine princess
summer winter spring autumn secret access hello freedom whatever trust batman superman computer internet service
server default change please user root guest test demo example sample value token key pass love happy family friend
house flower orange purple yellow green black white silver golden cookie chocolate coffee pepper ginger soccer hockey
tiger eagle falcon phoenix thunder lightning diamond crystal magic wizard hunter ranger killer soldier captain pirate
january february march april may june july august september october november december monday friday sunday correct
horse battery staple placeholder dummy redacted none null true false string your my the and for not this that here""".split()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
LEET = str.maketrans("4@8301!$57", "aabeoiisst")
DATE = re.compile(r"(?:19|20)\d{2}([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d{2}|\d{2})|(?:19|20)\d{2}")


#: Addresses, and the parts of urls in which there are words only: they are public, and one guesses them as a whole. A word in
#: a large first letter, as nouns of other languages are, may be unknown if its letters go like a word's.
ADDRESS = re.compile(
    r"(?<![A-Za-z0-9._-])[A-Za-z]++(?:[._-][A-Za-z]++)*+[0-9]{0,4}+@[A-Za-z0-9-]++(?:\.[A-Za-z-]{2,}+)++"
    r"|(?<![a-z0-9+])[a-z][a-z0-9+]*+://[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?::[0-9]++)?+(?:/[A-Za-z]*+(?:[-_.][A-Za-z]++)*+)*+",
    re.A,
)
NOUN = re.compile(r"(?<![^\W\d_])(?=[^\W\d_]{8,40}+(?![^\W\d_]))[A-ZÀ-Þ](?:[^\W\d_aeiouyA-Z]{0,4}+[aeiouyà-ÿ]{1,3}+)++[^\W\d_aeiouyA-Z]{0,4}+(?![^\W\d_])")
ADDRESS_COST, NOUN_COST = 5.0, 6.0
DATES = (4, 6, 8, 10)  # lengths of what it matches


def keyboard() -> dict[str, set[str]]:
    """Neighbours of each key, rows shifted by half a key."""
    near: dict[str, set[str]] = {}
    for r, row in enumerate(ROWS):
        for i, key in enumerate(row):
            around = {(r, i - 1), (r, i + 1), (r - 1, i), (r - 1, i + 1), (r + 1, i - 1), (r + 1, i)}
            near[key] = {ROWS[a][b] for a, b in around if 0 <= a < len(ROWS) and 0 <= b < len(ROWS[a])}
    return near


NEAR = keyboard()
PLACE = {key: (r, i) for r, row in enumerate(ROWS) for i, key in enumerate(row)}


def char_cost(c: str) -> float:
    """log10 of the characters one would try in its place."""
    return math.log10(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100)


def word_cost(s: str, ranks: Mapping[str, int] = RANK) -> float | None:
    """Of a word in any case, or with digits and signs for letters that look like them."""
    low = s.lower()
    plain = low if low in ranks else low.translate(LEET)
    if plain not in ranks or len(low) != len(s):
        return None
    changed = sum(a != b for a, b in zip(low, plain, strict=True))
    shape = 0.0 if s == low else 0.301 if s in (low.capitalize(), s.upper()) else sum(c.isupper() for c in s) * 0.5
    return math.log10(ranks[plain] + 1) + shape + changed * 0.4


def date_cost(s: str) -> float | None:
    return None if not DATE.fullmatch(s) else math.log10(365 * 120 * 4) if len(s) > 4 else math.log10(120)


def repeat_cost(s: str) -> float | None:
    for period in range(1, min(PERIODS, len(s) // 2) + 1):
        if s[period:] == s[:-period]:
            return sum(map(char_cost, s[:period])) + math.log10(len(s))
    return None


def step(a: str, b: str) -> tuple[int, int] | None:
    """From a key to a neighbouring one."""
    if b not in NEAR.get(a, ()):
        return None
    return PLACE[b][0] - PLACE[a][0], PLACE[b][1] - PLACE[a][1]


def walk_cost(s: str) -> float | None:
    keys = s.lower().translate(SHIFTED)
    steps = [step(a, b) for a, b in zip(keys, keys[1:], strict=False)]
    if len(s) < 3 or len(keys) != len(s) or None in steps:
        return None
    turns = 1 + sum(a != b for a, b in zip(steps, steps[1:], strict=False))
    return math.log10(47) + turns * math.log10(6) + math.log10(len(s))


def span_cost(s: str, ranks: Mapping[str, int] = RANK) -> float | None:
    """log10 of the guesses for s as one word, date, repeat or keyboard walk; None if it is none of these."""
    known = [c for c in (word_cost(s, ranks), date_cost(s), repeat_cost(s), walk_cost(s)) if c is not None]
    return min(known) if known else None


def whole_spans(value: str) -> dict[int, list[tuple[int, float]]]:
    """End of each address and noun in the value -> (start, cost)."""
    out: dict[int, list[tuple[int, float]]] = {}
    for pattern, cost in ((ADDRESS, ADDRESS_COST), (NOUN, NOUN_COST)):
        for m in pattern.finditer(value):
            out.setdefault(m.end(), []).append((m.start(), cost))
    return out


def smallest_period(s: str) -> int:
    """By the table of borders, in linear time."""
    border, k = [0] * len(s), 0
    for i in range(1, len(s)):
        while k and s[i] != s[k]:
            k = border[k - 1]
        k += s[i] == s[k]
        border[i] = k
    return len(s) - border[-1] if s else 0


def guess_cost(value: str, ranks: Mapping[str, int] = RANK) -> float:
    """log10 of the guesses for value: the least over all ways to cut it into spans, and 0.3 a known span.

    A dynamic program over ends: the last span is a brute-force character, a word, an address, a date, a repeat or a walk. Words and
    dates end within a few characters of their start. Repeats (a period each) and walks are carried along: the cheapest
    start that the run at hand still covers goes on, so time is linear in the length. A value that as a whole repeats a
    longer part costs that part.
    """
    period = smallest_period(value)
    if PERIODS < period <= len(value) // 2:
        return guess_cost(value[:period], ranks) + math.log10(len(value)) + CUT
    n = len(value)
    low = value.lower() if len(value.lower()) == n else value
    plain = low.translate(LEET)
    keys = low.translate(SHIFTED)
    single = [char_cost(c) for c in value]
    upto = [0.0]
    for c in single:
        upto.append(upto[-1] + c)
    best = [0.0] + [math.inf] * n
    run = [0] * (PERIODS + 1)  # characters that equal the one a period before
    repeat: list[tuple[float, int]] = [(math.inf, 0)] * (PERIODS + 1)  # cost without length, and start
    walk, walk_start, before = math.inf, 0, None
    whole = whole_spans(value)
    for j in range(1, n + 1):
        c = best[j - 1] + single[j - 1]
        for i, cost in whole.get(j, ()):
            c = min(c, best[i] + cost + CUT)
        for length in range(2, min(LONGEST_WORD, j) + 1):
            i = j - length
            if (low[i:j] in ranks or plain[i:j] in ranks) and best[i] + CUT < c and (w := word_cost(value[i:j], ranks)) is not None:
                c = min(c, best[i] + w + CUT)
        for length in DATES if value[j - 1].isdigit() else ():
            if length <= j and (d := date_cost(value[j - length : j])) is not None:
                c = min(c, best[j - length] + d + CUT)
        for p in range(1, min(PERIODS, j - 1) + 1):
            if value[j - 1] != value[j - 1 - p]:
                run[p], repeat[p] = 0, (math.inf, 0)
                continue
            run[p] += 1
            if run[p] >= p:
                i = j - 2 * p
                repeat[p] = min(repeat[p], (best[i] + upto[i + p] - upto[i], i))
                c = min(c, repeat[p][0] + math.log10(j - repeat[p][1]) + CUT)
        way = step(keys[j - 2], keys[j - 1]) if j >= 2 else None
        if way is None:
            walk = math.inf
        else:
            walk += 0 if way == before else math.log10(6)
            if (fresh := best[j - 2] + math.log10(47) + math.log10(6)) < walk:
                walk, walk_start = fresh, j - 2
            if j - walk_start >= 3:
                c = min(c, walk + math.log10(j - walk_start) + CUT)
        before = way
        best[j] = c
    return best[-1]


def common_words(docs: DataFrame, text_col: str = "text", most: int = MOST_WORDS) -> dict[str, int]:
    """Ranks of the words of a to z that come in most documents, behind those of RANK: `most` rows at most come to the
    driver. Every document is counted; each task adds up its own documents first."""
    bound_batches(docs.sparkSession)
    word = re.compile(rf"(?<![a-z])[a-z]{{3,{LONGEST_WORD}}}(?![a-z])")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(set(word.findall(text.lower())))
                if len(held) > HELD_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
                    held.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    counts = docs.select(empty_if_null(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    ranks = dict(RANK)
    for r in counts.where("n > 1").orderBy(F.desc("n"), "word").limit(most).collect():
        ranks.setdefault(r["word"], len(ranks) + 1)
    return ranks


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns' matches, by start, then kind as listed."""
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text):
            if (kind == "assign" and len(m[2]) >= 6) or (kind == "access" and len(m[0]) >= 20) or kind == "hex":
                out.append((m.start(), order, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def guessed_spans(text: str, base: list[tuple[int, int, str]], least: float = GUESSES, ranks: Mapping[str, int] = RANK) -> tuple[list[tuple[int, int, str]], float]:
    """Values in a credential's context that take over 10**least guesses and that no base span covers whole; the highest cost
    of all values. After `is` and `was`, where prose goes on, a value must hold something besides letters."""
    out, highest = [], 0.0
    for m in CONTEXT.finditer(text):
        a, b = m.span("value")
        quoted = text[a] in "\"'" and b - a >= 2 and text[b - 1] == text[a]
        if quoted:
            a, b = a + 1, b - 1
        else:
            b = a + len(text[a:b].rstrip(".:!?)]}"))
        if a >= b or (not quoted and m["sign"] is None and all(c.isalpha() or c in "-'\u2019" for c in text[a:b])):
            continue
        cost = guess_cost(text[a:b], ranks)
        highest = max(highest, cost)
        if cost > least and not any(x <= a and b <= y for x, y, _ in base):
            out.append((a, b, "guess"))
    return out, highest


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = GUESSES, ranks: Mapping[str, int] | None = None) -> DataFrame:
    """One row per row of docs: doc_id, base and added (arrays of struct start, end, kind, in code points, end exclusive),
    guess_log10 (of the costliest value in a credential's context; 0 without one). Words are those of `ranks`, or the
    common ones of docs themselves.

    A null text counts as empty and holds nothing; a null doc_id stays null; repeated rows come as often as given;
    other columns are not looked at. Each text is looked at whole.
    """
    bound_batches(docs.sparkSession)
    words = dict(ranks) if ranks is not None else common_words(docs, text_col)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added, cost = [], [], []
            for text in batch.column(1).to_pylist():
                own = base_spans(text)
                more, highest = guessed_spans(text, own, least, words)
                base.append([{"start": a, "end": b, "kind": k} for a, b, k in own])
                added.append([{"start": a, "end": b, "kind": k} for a, b, k in more])
                cost.append(highest)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(added, span), pa.array(cost, pa.float64())], ["doc_id", "base", "added", "guess_log10"])

    kind = "array<struct<start:long,end:long,kind:string>>"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"))
    return rows.mapInArrow(find, f"doc_id long, base {kind}, added {kind}, guess_log10 double")
