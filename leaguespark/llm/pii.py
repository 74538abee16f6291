"""Personal data by weak supervision, with built-in functions only.

1. Candidates.  One regular expression pass a kind marks the matches; the marked
   text is split at the marks, and running sums of the pieces' lengths give the
   offsets (code points, end exclusive).  The sums are taken in blocks, and spans
   that lie on base spans are found by sorting ends and starts together, so a text
   with very many spans stays near linear.  The expressions are written without
   backtracking (possessive, anchored at the start of a run), so a text of one
   endless run stays linear; they match what the plain expressions match.
2. Votes.  Four labelers look at each candidate and say yes (1), no (0) or
   nothing (-): form (checksums, ranges and number plans), gazetteer (known
   top-level domains, issuers, country prefixes and lengths, reserved addresses,
   names), context (cue words before the match) and texture (many different
   digits, or a placeholder's repeated ones).
3. Expectation-maximisation estimates, from the counts of vote patterns alone
   (at most 11 kinds x 3^4 patterns, whatever the input), how reliable each
   labeler is and how likely each pattern is personal data.
4. A logistic span classifier is trained on these probabilities, from counts by
   kind and eight yes-no features of the span.  It decides which candidates of the
   added kinds are spans, and says of each base span whether it is likely personal
   (``likely``: a reserved address or a placeholder number is not).  Base spans
   stay as the contract has them.

Base kinds: email, ip, card, phone.  Added kinds: ssn, iban, local (phone without
country code), name (title and surname), hidden (e-mail with "(at)"), ipv6, intl
(phone with 00); they never overlap a base span.

Defined cases: null and empty texts have no spans; U+0001, used as the mark, is
read as U+0002, which no expression takes; repeated rows are answered alike;
without any candidates the classifier accepts nothing; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguespark.llm.common import stash

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("ssn", "iban", "local", "name", "hidden", "ipv6", "intl")
LABELERS = 4
EM_ROUNDS = 40
ACCEPT = 0.5
#: Numbers that are summed at a time, one after the other.
SUMMED = 128

#: The kinds' expressions, possessive and anchored so as not to backtrack.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[ -]?[0-9])++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_ADDED = r"(?<![A-Za-z0-9])(?=[0-9(A-Z])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|00[1-9][0-9]{0,2}(?: ?[0-9]{2,4}){2,5}|\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}|(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]+(?: [A-Z][a-z]+)?)(?![A-Za-z0-9])"
_HIDDEN = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]++(?: ?[\[(] ?(?:dot|DOT) ?[\])] ?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++"
_DOT = r" ?[\[(] ?(?:dot|DOT) ?[\])] ?"
_AT = r"(?:at|AT) ?[\])]"
_IPV6 = r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])"
#: The gazetteers and cue words of the labelers.
_DOMAINS = r"(?i)\.(com|org|net|edu|gov|info|fr|de|es|uk|it|eu|io|us|ca|au|ch|be|nl|at|pt|br|mx|jp|cn|in)$"
_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|30)"
_COUNTRIES = r"^\+(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_RESERVED = r"^(0|10|127|169\.254|172\.(1[6-9]|2[0-9]|3[01])|192\.168|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
_NAMES = r"(?i) (smith|jones|taylor|brown|williams|wilson|johnson|davies|miller|davis|garcia|martin|bernard|dubois|durand|petit|moreau|muller|schmidt|schneider|fischer|weber|meyer|wagner|rossi|russo|ferrari|lopez|martinez|sanchez|perez|gonzalez|silva|santos|nguyen|kim|lee|chen|wang|singh|kumar|khan|ali|novak|jensen|hansen|larsen|andersen|kowalski)$"
#: Lengths of account numbers by country.
_IBAN = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
_CUES = r"(?i)(mail|contact|tel|phone|call|fax|mobile|card|visa|credit|ip|host|server|address|ssn|social|iban|account|bank|name|from|to|at|by|with|me|ipv6)[ .:=#-]*$"
_COUNTER_CUES = r"(?i)(version|token|hash|id|isbn|order|invoice|build|release|serial|ref|no)[ .:=#-]*$"
#: Characters before a match that the context labeler sees.
CONTEXT = 24


def _parts(pattern: str, gate: str) -> str:
    """SQL for the pieces of a text: even ones lie between the matches, odd ones are matches."""
    return f"CASE WHEN {gate} THEN split(regexp_replace(text, {_sql(pattern)}, '\\u0001$0\\u0001'), '\\u0001', -1) ELSE array(text) END"


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often lambdas in it ask for it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(numbers: Column) -> Column:
    """For each number of an array the sum of those before it; in blocks, as an array that grows is copied at each step."""
    zero = F.lit(0).cast("long")
    grow = lambda out, x: F.concat(out, F.array(F.element_at(out, -1) + x))

    def cut(n: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / SUMMED).cast("int")), lambda i: F.slice(n, i * SUMMED + 1, F.lit(SUMMED)))

    def summed(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda t, x: t + x))
        first = F.slice(F.aggregate(totals, F.array(zero), grow), F.lit(1), F.size(blocks))
        return F.flatten(F.zip_with(blocks, first, lambda b, f: F.slice(F.aggregate(b, F.array(f), grow), F.lit(1), F.size(b))))

    return _let(numbers, lambda n: F.when(F.size(n) > 0, _let(cut(n), summed)).otherwise(F.array().cast("array<bigint>")))


def _hits(parts: Column) -> Column:
    """(hit, before, start) of all matches, given the pieces."""
    starts = sums_before(F.transform(parts, lambda p: F.length(p).cast("long")))
    zipped = F.arrays_zip(parts.alias("hit"), F.concat(F.array(F.lit("")), parts).alias("before"), starts.alias("start"))
    odd = F.filter(zipped, lambda x, i: (i % 2 == 1) & x["hit"].isNotNull())
    found = F.transform(odd, lambda x: F.struct(x["hit"].alias("hit"), F.right(x["before"], F.lit(CONTEXT)).alias("before"), x["start"].alias("start")))
    return F.when(F.size(parts) > 1, found).otherwise(F.array().cast("array<struct<hit:string,before:string,start:bigint>>"))


def off_base(added: Column, base: Column) -> Column:
    """The added spans that touch no base span: as many base spans begin before their end as end up to their start."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    event = lambda at, order, i, begins, ends: F.struct(at.alias("at"), F.lit(order).alias("order"), i.cast("long").alias("i"), begins.alias("begins"), ends.alias("ends"))
    events = F.sort_array(F.concat(
        F.transform(base, lambda b: event(b["start"], 2, F.lit(-1), one, zero)), F.transform(base, lambda b: event(b["end"], 0, F.lit(-1), zero, one)),
        F.transform(added, lambda a, i: event(a["start"], 1, 2 * i, zero, zero)), F.transform(added, lambda a, i: event(a["end"], 1, 2 * i + 1, zero, zero)),
    ))

    def answers(e: Column) -> Column:
        begun, ended = sums_before(F.transform(e, lambda x: x["begins"])), sums_before(F.transform(e, lambda x: x["ends"]))
        asked = F.filter(F.arrays_zip(e.alias("e"), begun.alias("begun"), ended.alias("ended")), lambda x: x["e"]["i"] >= 0)
        return F.sort_array(F.transform(asked, lambda x: F.struct(x["e"]["i"].alias("i"), F.when(x["e"]["i"] % 2 == 1, x["begun"]).otherwise(x["ended"]).alias("n"))))

    def over(found: Column) -> Column:
        return F.zip_with(F.filter(found, lambda _, i: i % 2 == 0), F.filter(found, lambda _, i: i % 2 == 1), lambda start, end: end["n"] - start["n"])

    counts = _let(_let(events, answers), over)
    clear = F.transform(F.filter(F.arrays_zip(added.alias("a"), counts.alias("over")), lambda x: x["over"] == 0), lambda x: x["a"])
    return F.when((F.size(added) == 0) | (F.size(base) == 0), added).otherwise(clear)


_LUHN = """aggregate(transform(regexp_extract_all(reverse(x.hit), '[0-9]', 0),
    (d, i) -> CASE WHEN i % 2 = 0 THEN cast(d AS int) WHEN d >= '5' THEN 2 * cast(d AS int) - 9 ELSE 2 * cast(d AS int) END), 0, (a, b) -> a + b) % 10 = 0"""
_DIGITS = "length(regexp_replace(x.hit, '[^0-9]+', ''))"
_FORM = {
    "email": "true",
    "ip": "forall(split(x.hit, '\\\\.'), p -> coalesce(try_cast(p AS int) <= 255, false))",
    "card": f"CASE WHEN {_DIGITS} BETWEEN 13 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"{_DIGITS} BETWEEN 9 AND 15",
}


_IBAN_LENGTH = "CASE left(x.hit, 2) " + " ".join(f"WHEN '{c}' THEN {n}" for c, n in _IBAN.items()) + " ELSE 0 END"
_MOD_97 = """aggregate(split(concat(substring(x.hit, 5), left(x.hit, 4)), ''), 0,
    (r, c) -> CASE WHEN c = '' THEN r WHEN c <= '9' THEN (r * 10 + cast(c AS int)) % 97 ELSE (r * 100 + ascii(c) - 55) % 97 END) = 1"""
_ADDED_FORM = f"""CASE
    WHEN x.kind = 'ssn' THEN NOT x.hit RLIKE '^(000|666|9)|-00-|-0000$'
    WHEN x.kind = 'iban' THEN {_MOD_97}
    WHEN x.kind = 'local' THEN x.hit RLIKE '^[(]?[2-9][0-9]{{2}}[)]?[ .-][2-9]'
    WHEN x.kind = 'name' THEN length(x.hit) >= 7
    WHEN x.kind = 'hidden' THEN x.hit RLIKE '[A-Za-z]{{2,}}$'
    WHEN x.kind = 'ipv6' THEN NOT x.hit RLIKE '^(0+:)+'
    ELSE {_DIGITS} BETWEEN 10 AND 17 END"""


def _vote(yes: str, no: str) -> str:
    return f"CASE WHEN {no} THEN '0' WHEN {yes} THEN '1' ELSE '-' END"


_GAZETTEER = f"""CASE x.kind
    WHEN 'email' THEN {_vote(f"x.hit RLIKE {_sql(_DOMAINS)}", "x.hit RLIKE '@.*[0-9]$'")}
    WHEN 'ip' THEN {_vote("true", f"x.hit RLIKE {_sql(_RESERVED)}")}
    WHEN 'card' THEN {_vote("true", f"NOT x.hit RLIKE {_sql(_ISSUERS)}")}
    WHEN 'phone' THEN {_vote("true", f"NOT x.hit RLIKE {_sql(_COUNTRIES)}")}
    WHEN 'iban' THEN {_vote(f"length(x.hit) = {_IBAN_LENGTH}", f"length(x.hit) <> {_IBAN_LENGTH}")}
    WHEN 'local' THEN {_vote("false", "x.hit RLIKE '555.01[0-9]{2}$'")}
    WHEN 'name' THEN {_vote(f"x.hit RLIKE {_sql(_NAMES)}", "false")}
    WHEN 'hidden' THEN {_vote(f"regexp_replace(x.hit, {_sql(_DOT)}, '.') RLIKE {_sql(_DOMAINS)}", "false")}
    WHEN 'ipv6' THEN {_vote("x.hit RLIKE '^2[0-9a-fA-F]{3}:'", "x.hit RLIKE '(?i)^(f[cdef]|2001:0?db8)'")}
    WHEN 'intl' THEN {_vote("true", f"NOT concat('+', substring(x.hit, 3)) RLIKE {_sql(_COUNTRIES)}")}
    ELSE '-' END"""
_VOTES = f"""concat(
    CASE WHEN x.valid THEN '1' ELSE '0' END,
    {_GAZETTEER},
    {_vote(f"x.before RLIKE {_sql(_CUES)}", f"x.before RLIKE {_sql(_COUNTER_CUES)}")},
    CASE WHEN x.kind IN ('email', 'hidden', 'name') THEN '-' ELSE {_vote("size(array_distinct(regexp_extract_all(x.hit, '[0-9]', 0))) >= 4", "x.hit RLIKE '([0-9])[^0-9]*(\\\\1[^0-9]*){6}' OR x.hit LIKE '%1234567%'")} END)"""
_FEATURES = f"""concat(
    CASE WHEN length(x.hit) >= 16 THEN '1' ELSE '0' END,
    CASE WHEN x.hit RLIKE '[ ().-]' THEN '1' ELSE '0' END,
    CASE WHEN x.hit RLIKE '[A-Za-z]' THEN '1' ELSE '0' END,
    CASE WHEN x.before RLIKE '[:=#] *$' THEN '1' ELSE '0' END,
    CASE WHEN x.before = '' OR x.before RLIKE '\\\\n$' THEN '1' ELSE '0' END,
    CASE WHEN x.valid THEN '1' ELSE '0' END,
    CASE WHEN x.before RLIKE {_sql(_CUES)} THEN '1' ELSE '0' END,
    CASE WHEN {_GAZETTEER} = '0' THEN '1' ELSE '0' END)"""


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): arrays of (kind, start, end, votes, features); base holds the contract's spans, by kind and start."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "\u0001", "\u0002").alias("text"))
    gates = {"email": "contains(text, '@')", "ip": "contains(text, '.')", "card": "true", "phone": "contains(text, '+')", "added": "true", "hidden": f"text RLIKE {_sql(_AT)}", "ipv6": "text RLIKE '[0-9A-Fa-f]:[0-9A-Fa-f]'"}
    patterns = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE, "added": _ADDED, "hidden": _HIDDEN, "ipv6": _IPV6}
    rows = rows.select("doc_id", *[F.expr(_parts(pattern, gates[kind])).alias(f"parts_{kind}") for kind, pattern in patterns.items()])
    rows = rows.select("doc_id", *[_hits(F.col(f"parts_{kind}")).alias(kind) for kind in patterns])
    span = "named_struct('kind', {kind}, 'hit', x.hit, 'before', x.before, 'start', x.start, 'end', x.start + length(x.hit), 'valid', {valid})"
    base = ", ".join(f"transform({kind}, x -> {span.format(kind=repr(kind), valid=_FORM[kind])})" for kind in BASE_KINDS)
    added_kind = "CASE WHEN x.hit RLIKE '^[0-9]{3}-[0-9]{2}-' THEN 'ssn' WHEN x.hit RLIKE '^[A-Z]{2}[0-9]' THEN 'iban' WHEN x.hit RLIKE '^00[1-9][0-9 ]+$' THEN 'intl' WHEN x.hit RLIKE '^[(0-9]' THEN 'local' ELSE 'name' END"
    added = ", ".join(f"transform({kind}, x -> {span.format(kind=name, valid='true')})" for kind, name in (("added", added_kind), ("hidden", "'hidden'"), ("ipv6", "'ipv6'")))
    rows = rows.select("doc_id", F.expr(f"filter(concat({base}), x -> x.valid OR x.kind <> 'card' OR length(x.hit) >= 13)").alias("base"), F.expr(f"concat({added})").alias("added"))
    rows = rows.select("doc_id", "base", F.filter("base", lambda b: b["valid"]).alias("valid"), F.expr(f"transform(added, x -> named_struct('kind', x.kind, 'hit', x.hit, 'before', x.before, 'start', x.start, 'end', x.end, 'valid', {_ADDED_FORM}))").alias("added"))
    rows = rows.select("doc_id", "base", off_base(F.col("added"), F.col("valid")).alias("added"))
    judged = "named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'valid', x.valid, 'votes', {votes}, 'features', {features})".format(votes=_VOTES, features=_FEATURES)
    return rows.select("doc_id", F.expr(f"transform(base, x -> {judged})").alias("base"), F.expr(f"transform(added, x -> {judged})").alias("added"))


def estimate(patterns: dict[tuple[str, str], int]) -> dict[tuple[str, str], float]:
    """Probability of personal data by (kind, votes), by expectation-maximisation over pattern counts.

    Each labeler has two reliabilities, shared by all kinds: how often it says yes
    to personal data and to anything else, given that it speaks.  Each kind has its
    own share of personal data.
    """
    kinds = sorted({kind for kind, _ in patterns})
    share = dict.fromkeys(kinds, 0.5)
    yes = [[0.8, 0.3] for _ in range(LABELERS)]
    posterior: dict[tuple[str, str], float] = {}
    for _ in range(EM_ROUNDS):
        for kind, votes in sorted(patterns):
            log = [math.log(share[kind]), math.log(1 - share[kind])]
            for labeler, vote in enumerate(votes):
                if vote != "-":
                    for c in (0, 1):
                        log[c] += math.log(yes[labeler][c] if vote == "1" else 1 - yes[labeler][c])
            posterior[kind, votes] = 1 / (1 + math.exp(min(500.0, log[1] - log[0])))
        for kind in kinds:
            own = [(posterior[p], n) for p, n in patterns.items() if p[0] == kind]
            share[kind] = (sum(q * n for q, n in own) + 1) / (sum(n for _, n in own) + 2)
        for labeler in range(LABELERS):
            for c in (0, 1):
                spoke = [(p[1][labeler], (q if c == 0 else 1 - q) * patterns[p]) for p, q in posterior.items() if p[1][labeler] != "-"]
                # The prior keeps the labels' meaning: yes stays likelier for personal data.
                yes[labeler][c] = (sum(w for v, w in spoke if v == "1") + (8 if c == 0 else 3)) / (sum(w for _, w in spoke) + 10 + (0 if c == 0 else 1))
    return posterior


def train(counts: dict[tuple[str, str], tuple[float, float]], rounds: int = 300) -> dict[str, float]:
    """Weights of a logistic classifier by kind and feature; counts: (kind, features) -> (all, expected personal)."""
    weights: dict[str, float] = {}
    total = sum(n for n, _ in counts.values()) or 1.0
    names = {key: [f"kind:{key[0]}", *[f"f{i}" for i, bit in enumerate(key[1]) if bit == "1"]] for key in counts}
    for _ in range(rounds):
        grad: dict[str, float] = {}
        for key in sorted(counts):
            n, personal = counts[key]
            z = sum(weights.get(name, 0.0) for name in names[key])
            error = (personal - n / (1 + math.exp(-max(-30.0, min(30.0, z))))) / total
            for name in names[key]:
                grad[name] = grad.get(name, 0.0) + error
        for name, g in grad.items():
            weights[name] = weights.get(name, 0.0) + 4.0 * (g - 1e-4 * weights.get(name, 0.0))
    return weights


def fit(found: DataFrame) -> dict[str, float]:
    """The span classifier's weights from all candidates; at most 11 x 81 x 256 counts reach the driver."""
    each = found.select(F.explode(F.concat("base", "added")).alias("x"))
    rows = each.groupBy("x.kind", "x.votes", "x.features").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns: dict[tuple[str, str], int] = {}
    for r in rows:
        patterns[r.kind, r.votes] = patterns.get((r.kind, r.votes), 0) + r.n
    posterior = estimate(patterns)
    counts: dict[tuple[str, str], tuple[float, float]] = {}
    for r in rows:
        n, personal = counts.get((r.kind, r.features), (0.0, 0.0))
        counts[r.kind, r.features] = n + r.n, personal + r.n * posterior[r.kind, r.votes]
    return train(counts)


def _logit(weights: dict[str, float], x: Column) -> Column:
    z = F.lit(0.0)
    for name, weight in sorted(weights.items()):
        if name.startswith("kind:"):
            z = z + F.when(x["kind"] == name[5:], weight).otherwise(0.0)
        else:
            z = z + F.when(F.substring(x["features"], int(name[1:]) + 1, 1) == "1", weight).otherwise(0.0)
    return z


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): base spans and the added spans that the classifier accepts, as arrays of (kind, start, end); base spans also say if they are ``likely``."""
    found = stash(candidates(docs))
    weights = fit(found)
    likely = lambda x: _logit(weights, x) >= math.log(ACCEPT / (1 - ACCEPT))
    span = lambda x: [x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")]
    base = F.transform(F.filter("base", lambda x: x["valid"]), lambda x: F.struct(*span(x), likely(x).alias("likely")))
    of_kind = lambda kind: F.filter("added", lambda x: (x["kind"] == kind) & likely(x))
    added = F.concat(*[F.transform(of_kind(kind), lambda x: F.struct(*span(x))) for kind in ADDED_KINDS])
    return found.select("doc_id", base.alias("base"), added.alias("added"))
