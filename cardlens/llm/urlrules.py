"""URL rules, found by their rarest literal token."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import bound_batches

TOKEN = re.compile(r"[a-z0-9]+")
MOST_RULES = 200_000  # what a task's index may hold; more is refused


@dataclass(frozen=True)
class Rule:
    """A host rule has host and path and is named host + path; a pattern rule has a regular expression for the whole
    url (host in lower case) and its literal tokens."""

    action: str
    host: str = ""
    path: str = ""
    pattern: str = ""
    tokens: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.host + self.path if self.host else self.pattern

    def expression(self) -> str:
        if self.pattern:
            return self.pattern
        return rf"^(?>.*?://)(?:[^/?#]*\.)?{re.escape(self.host)}(?=[/?#]|$){re.escape(self.path)}"

    def literals(self) -> tuple[str, ...]:
        """Tokens that every url the rule fits has whole: of the host all; of the path those that other characters bound."""
        if self.pattern:
            return self.tokens
        whole = self.path.lower() if self.path.endswith("/") else self.path.lower().rpartition("/")[0] + "/"
        return tuple(dict.fromkeys(TOKEN.findall(self.host.lower()) + TOKEN.findall(whole)))


BASE = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
#: The method's own rules: farms, tracking and adult words, session ids.
PATTERN_RULES = (
    Rule("block", pattern=r"^[^/]*//(?:[^/?#]*\.)?spam-farm\.", tokens=("spam", "farm")),
    Rule("block", pattern=r"[?&]sessionid=[0-9a-z]{8,}", tokens=("sessionid",)),
    Rule("block", pattern=r"^[^/]*//(?:[^/?#]*\.)?(?:[a-z0-9]+-)?casino(?:-[a-z0-9]+)?\.", tokens=("casino",)),
    Rule("block", pattern=r"/(?:wp-login|xmlrpc)\.php(?:[?#]|$)", tokens=("php",)),
    Rule("allow", pattern=r"/robots\.txt$", tokens=("robots", "txt")),
)


#: Options of filter lists that don't narrow a rule down for pages. Fixed values.
PLAIN_OPTIONS = {"all", "doc", "document", "important"}


def parse_rule(line: str) -> Rule | None:
    """A pattern rule from one line of a filter list; None for blank lines, comments and element rules.

    @@ begins an exception (allow); || anchors at the beginning of a host's label, | at the beginning or end of the url;
    * stands for anything and ^ for a separator or the end; a line between two / is a regular expression. Letters count in
    lower case, as urls are matched. A literal token counts for the index only if the line bounds it on both sides.
    Options behind $ narrow a rule down by what a url doesn't tell (who asks for it, and for what): such rules are left out,
    but for the options of PLAIN_OPTIONS, which leave a rule as wide as it is.
    """
    line = line.strip()
    if not line or line[0] in "![" or "##" in line or "#@#" in line:
        return None
    action = "allow" if line.startswith("@@") else "block"
    body = line.removeprefix("@@")
    expression = re.fullmatch(r"/(.+)/(?:\$([a-z0-9~=|.,_-]+))?", body)
    body, options = (body, expression[2] or "") if expression else (lambda b, _, o: (b, o))(*body.partition("$"))
    if {o for o in options.lower().split(",") if o} - PLAIN_OPTIONS:
        return None
    if expression:
        try:
            re.compile(expression[1])
        except re.error:
            return None
        return Rule(action, pattern=f"(?i:{expression[1]})")
    body = body.lower()
    out, bounded = "", ""
    if body.startswith("||"):
        out, body, bounded = r"^[^/]*//(?:[^/?#]*\.)?", body[2:], " "
    elif body.startswith("|"):
        out, body, bounded = "^", body[1:], " "
    end = body.endswith("|")
    body = body.removesuffix("|")
    if not body.strip("*"):
        return None
    whole = bounded + body.replace("*", "\x00") + (" " if end else "")
    found = tuple(dict.fromkeys(m[0] for m in re.finditer(r"(?<=[^a-z0-9\x00])[a-z0-9]+(?=[^a-z0-9\x00])", whole)))
    parts = {"*": ".*", "^": r"(?:[^a-z0-9_.%-]|$)"}
    pattern = out + "".join(parts.get(c, re.escape(c)) for c in body) + ("$" if end else "")
    return Rule(action, pattern=pattern, tokens=found)


def rules_of(table: DataFrame) -> tuple[Rule, ...]:
    """Rules from a table: column `line` holds lines of a filter list, or action, host and path hold host rules (null
    counts as empty). A rule that comes twice counts once. More than MOST_RULES are refused."""
    rows = table.distinct().limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"over {MOST_RULES} rules")
    if "line" in table.columns:
        held = [parse_rule(r["line"]) for r in rows if r["line"]]
    else:
        held = [Rule(r["action"], (r["host"] or "").lower(), r["path"] or "") for r in rows if r["host"]]
    return tuple(sorted({r for r in held if r}, key=lambda r: (r.name, r.action)))


def tokens(url: str) -> set[str]:
    return set(TOKEN.findall(url))


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """In how many urls each literal token of the rules comes: at most as many rows as the rules have tokens."""
    wanted = sorted({t for r in rules for t in r.literals()})
    spark = urls.sparkSession
    known = F.broadcast(spark.createDataFrame([(t,) for t in wanted], "token string"))
    seen = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("url"), F.lit("([a-z0-9]+)"), F.lit(1)))).alias("token"))
    return {t: 0 for t in wanted} | {r["token"]: r["n"] for r in seen.join(known, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def index_rules(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule numbers under the rarest literal token of each; rules without one under ''."""
    out = defaultdict(list)
    for k, r in enumerate(rules):
        out[min(r.literals(), key=lambda t: (counts.get(t, 0), t), default="")].append(k)
    return dict(out)


def judge(urls: DataFrame, rules: Sequence[Rule] | DataFrame = BASE + PATTERN_RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of urls: page_id, host, path, rule (name of the host rule that decides, or null), verdict, pattern.

    Rules are given or read from a table (rules_of). The longest host rule that fits decides; without one, a url that a blocking pattern fits and no allowing one is
    blocked (pattern names the first), and all others are allowed. Null urls and those without :// have an empty host
    and path and are allowed. Repeated rows are judged alike; other columns are not looked at.
    """
    rules = rules_of(rules) if isinstance(rules, DataFrame) else rules
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} fit a task's index")
    bound_batches(urls.sparkSession)
    rows = urls.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rules = tuple(rules)
    index = index_rules(rules, token_counts(rows, rules))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        always = index.get("", [])
        compiled: dict[int, re.Pattern] = {}
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for url in batch.column(1).to_pylist():
                for column, x in zip(out, one(url, always, compiled), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in out)], ["page_id", "host", "path", "rule", "verdict", "pattern"])

    def one(url: str | None, always: list[int], compiled: dict[int, re.Pattern]) -> tuple:
        scheme, mark, rest = (url or "").partition("://")
        if not mark:
            return "", "", None, "allow", None
        cut = re.search(r"[/?#]", rest)
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[: cut.start() if cut else len(rest)])
        tail = rest[cut.start() :] if cut else ""
        path = re.split(r"[?#]", tail, maxsplit=1)[0]
        plain = f"{scheme}://{host}{tail}"
        low = plain.lower()
        fit = []
        for k in dict.fromkeys([*always, *(k for t in sorted(tokens(low)) for k in index.get(t, ()))]):
            if k not in compiled:
                compiled[k] = re.compile(rules[k].expression(), re.A | re.S)
            if compiled[k].search(plain if rules[k].host else low):
                fit.append(rules[k])
        hosts = [r for r in fit if r.host]
        if hosts:
            best = max(hosts, key=lambda r: (len(r.name), r.name))
            return host, path, best.name, best.action, None
        allowed = [r for r in fit if r.action == "allow"]
        blocked = sorted(r.name for r in fit if r.action == "block")
        return host, path, None, "block" if blocked and not allowed else "allow", (blocked or [None])[0] if not allowed else None

    return rows.mapInArrow(decide, "page_id long, host string, path string, rule string, verdict string, pattern string")
