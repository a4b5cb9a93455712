"""Personal data found by labelers that vote, weighed by expectation-maximisation.

Patterns propose spans. Those of the base rules, validity included, always stay. Others, of looser shape, are voted
on by five labelers: a regular expression for the strict shape, a check of the digits or parts, a gazetteer,
words in front and the characters around. Labelers may abstain. Expectation-maximisation over all
candidates of the corpus estimates how reliable each labeler is, for each kind by itself and with the estimate over
all kinds as its prior, and how likely each candidate is; these likelihoods train a
logistic span classifier on votes, kind and shape, and candidates it accepts are added.

Everything that touches rows is a column expression. Only counts of vote and shape patterns, at most a few
thousand whatever the corpus, reach the driver.

Positions count code points from 0, ends are exclusive. Defined results: a null or empty text has no spans. Rows are
independent: repeated ids and texts each keep their row. Without candidates nothing is added. An added span
overlaps no base span. Runs of any length are matched in linear time and without recursion; a text with very many spans
takes time in proportion to their number, but for sorting them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import let, picked
from rankflow.session import cut, scratch

# The kinds in their order; the base patterns, whose last groups never need to give back.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{{1,63}}"
    r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}){1,5}",
    "card": r"(?<![0-9])(?:[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}"
    r"|3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9.+-])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_])(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,255}|glpat-[A-Za-z0-9_-]{20}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,255}|[sr]k_live_[A-Za-z0-9]{16,255}|AIza[A-Za-z0-9_-]{35}"
    r"|(?i:password|passwd|secret|api_?key|token)\x20?[=:]\x20?[\"']?[A-Za-z0-9_/+.-]{8,255})(?![A-Za-z0-9_])",
}
# A text without these has no match.
NEEDS = {
    "email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
    "loose email": r"(?i)[\[(]at[\])]", "loose card": r"[0-9]{4}", "loose phone": r"[0-9]{3}[\x20.-][0-9]{4}",
    "loose secret": r"A[KS]IA|gh[pousr]_|glpat-|xox[abprs]-|[sr]k_live_|AIza|[=:]",
}
# Gazetteers (ends of domains, country calling codes, prefixes of issued tokens) and context words.
DOMAIN_ENDS = (
    "com|org|net|edu|gov|mil|int|info|biz|name|io|ai|app|dev|co|me|tv|cloud|online|site|tech|xyz|example|"
    "ac|ae|ar|at|au|be|bg|br|ca|ch|cl|cn|cz|de|dk|ee|eg|es|eu|fi|fr|gr|hk|hr|hu|id|ie|il|in|ir|is|it|jp|ke|kr|lt|lu|lv|ma|"
    "mx|my|ng|nl|no|nz|pe|ph|pk|pl|pt|ro|rs|ru|sa|se|sg|si|sk|th|tr|tw|ua|uk|us|uy|ve|vn|za"
)
CALLING_CODES = (
    "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63|64|65|66|81|82|84|86|90|91|"
    "92|93|94|95|98|21[1-8]|22[0-9]|23[0-9]|24[0-9]|25[0-8]|26[0-9]|29[0-9]|35[0-9]|37[0-9]|38[0-9]|42[0-3]|50[0-9]|59[0-9]|"
    "67[0-9]|68[0-9]|69[0-2]|85[0-6]|88[0-6]|96[0-8]|97[0-7]|99[2-8]"
)
TOKEN_PREFIXES = "AKIA|ASIA|gh[pousr]_|glpat-|xox[abprs]-|sk_live_|rk_live_|AIza"
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|correo|courriel|kontakt)",
    "ip": r"(?i)(?:\bip\b|address|host|server|from)",
    "card": r"(?i)(?:card|visa|master|amex|pay|tarjeta|carte|karte)",
    "phone": r"(?i)(?:call|phone|tel|fax|mobile|sms|appel|ruf|llam)",
    "secret": r"(?i)(?:key|token|secret|pass|credential)",
}
AGAINST = r"(?i)(?:version|isbn|issn|order|invoice|serial|figure|table|page)[\x20#:.]*$"
CONTEXT = 40
# Arrays are scanned in blocks of this many entries, and these again, so that a scan is linear in effect.
BLOCK = 32
# Code points per piece when a text is cut up to be put together again.
PIECE = 1024
VOTERS = ("strict", "valid", "listed", "context", "around")
ROUNDS = 60
ACCEPT = 0.5
# Candidates of any kind that a kind's own estimate is weighed against.
PRIOR_ROWS = 20.0


def _sum(part: Column) -> Column:
    return F.aggregate(part, F.lit(0), lambda total, x: total + x)


def _most(part: Column) -> Column:
    return F.coalesce(F.array_max(part), F.lit(-1))


def scan(values: Column, fold, levels: int = 2) -> Column:
    """For each entry of an integer array the fold of all entries in front of it.

    ``fold`` is a sum, or a maximum of numbers that are not negative.
    """

    def before(block: Column) -> Column:
        return F.transform(block, lambda _, i: fold(F.slice(block, F.lit(1), i)))

    if levels == 0:
        return let(values, before)

    def blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(BLOCK))
        return let(F.transform(starts, lambda i: F.slice(v, i + 1, F.lit(BLOCK))), join)

    def join(parts: Column) -> Column:
        bases = scan(F.transform(parts, fold), fold, levels - 1)
        return F.flatten(F.zip_with(parts, bases, lambda block, base: F.transform(
            before(block), lambda own: fold(F.array(base, own))
        )))

    return let(values, blocks)


def find(text: Column, pattern: str, needs: str) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, end, match, before, after>>``.

    The text is split at its matches; a match starts after the segments and matches in front of it.
    """
    searched = F.when(text.rlike(needs), text).otherwise(F.lit(""))
    parts = let(searched, lambda t: F.struct(
        F.split(t, pattern, -1).alias("gaps"), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("hits")
    ))

    def spans(p: Column) -> Column:
        widths = F.zip_with(F.slice(p["gaps"], F.lit(1), F.size(p["hits"])), p["hits"], lambda g, h: F.length(g) + F.length(h))
        return let(scan(widths, _sum), lambda before: F.transform(p["hits"], lambda hit, i: span(p, before, hit, i)))

    def span(p: Column, before: Column, hit: Column, i: Column) -> Column:
        gap, after = F.get(p["gaps"], i), F.get(p["gaps"], i + 1)
        return let(F.get(before, i) + F.length(gap), lambda start: F.struct(
            start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("match"),
            F.right(gap, F.lit(CONTEXT)).alias("before"), F.substring(after, 1, 1).alias("after"),
        ))

    return let(parts, spans)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a short run of digits has a sum divisible by ten, every second one from the right doubled."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, 1, 1000).substr(F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def valid(kind: str, match: Column) -> Column:
    """The base rules' condition on a match; the digits' condition for looser ones."""
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return let(digits_of(match), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits_of(match)).between(8, 15)
    return F.lit(True)


def _votes(kind: str, x: Column) -> list[Column]:
    """1, -1 or 0 of each labeler."""
    vote = lambda yes, no=None: F.when(yes, 1).when(F.lit(False) if no is None else no, -1).otherwise(0)
    digits = digits_of(x["match"])
    strict = {
        "email": x["match"].rlike("^[^@]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}$"),
        "ip": x["match"].rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"),
        "card": x["match"].rlike(r"^(?:[0-9]{16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{13})$"),
        "phone": x["match"].rlike(r"^(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$"),
        "secret": x["match"].rlike(r"AKIA[0-9A-Z]{16}$|^gh[pousr]_|[0-9].*[A-Za-z]|[A-Za-z].*[0-9]"),
    }[kind]
    if kind == "card":
        checked = let(digits, lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False)))
    elif kind == "secret":
        checked = x["match"].rlike("[0-9]") & x["match"].rlike("[A-Za-z]")
    elif kind == "email":
        checked = ~x["match"].rlike(r"^[.-]|\.\.")
    else:
        checked = valid(kind, x["match"])
    listed = {
        "email": vote(x["match"].rlike(rf"(?i)[.\])\x20](?:{DOMAIN_ENDS})$")),
        "ip": vote(~x["match"].rlike(r"^(?:0|127|22[4-9]|2[3-5][0-9])\."), F.lit(True)),
        "card": vote(digits.rlike("^(?:3[47]|4|5[1-5]|2[2-7]|6)"), F.lit(True)),
        "phone": vote(
            F.concat(F.lit("+"), digits).rlike(rf"^\+(?:{CALLING_CODES})") & x["match"].rlike(r"^\+"), x["match"].rlike(r"^\+")
        ),
        "secret": vote(x["match"].rlike(f"^(?:{TOKEN_PREFIXES})")),
    }[kind]
    context = F.when(x["before"].rlike(AGAINST), -1).when(x["before"].rlike(CUES[kind]), 1).otherwise(0)
    around = vote(
        ~x["before"].rlike(r"[\p{L}\p{N}]$") & ~x["after"].rlike(r"^[\p{L}\p{N}]"),
        x["before"].rlike(r"[\p{L}\p{N}]$") | x["after"].rlike(r"^[\p{L}\p{N}]"),
    )
    return [vote(strict, ~strict), vote(checked, ~checked), listed, context, around]


def _shape(match: Column) -> Column:
    """A coarse shape: how long, and how much of it is digits."""
    share = F.floor(F.length(digits_of(match)) * 4 / F.greatest(F.length(match), F.lit(1)))
    return F.least(F.floor(F.length(match) / 8), F.lit(3)).cast("int") * 5 + share.cast("int")


def candidates(text: Column) -> Column:
    """All proposals of one text, ``array<struct<kind, start, end, base, votes, shape>>``; ``kind`` is a number."""
    whole = F.coalesce(text, F.lit(""))

    def of_kind(t: Column, kind: str, base: bool) -> Column:
        pattern, needs = (BASE[kind], NEEDS[kind]) if base else (LOOSE[kind], NEEDS[f"loose {kind}"])
        spans = find(t, pattern, needs)
        if base:
            spans = F.filter(spans, lambda x: valid(kind, x["match"]))
        return F.transform(spans, lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            F.lit(base).alias("base"), F.array(*_votes(kind, x)).alias("votes"), _shape(x["match"]).alias("shape"),
        ))

    def proposals(t: Column) -> Column:
        found = [of_kind(t, kind, True) for kind in BASE] + [of_kind(t, kind, False) for kind in LOOSE]
        return let(F.concat(*found), apart)

    def apart(spans: Column) -> Column:
        return F.when(F.forall(spans, lambda x: x["base"]), spans).otherwise(
            let(F.array_sort(spans, _by_start), without_overlaps)
        )

    def without_overlaps(spans: Column) -> Column:
        # In order of their starts, a span meets a base span in front that ends behind its start, or the next one
        # if that starts before its end.
        ends = F.transform(spans, lambda x: F.when(x["base"], x["end"]).otherwise(-1))
        far = 1 << 30
        nearness = F.transform(spans, lambda x: F.when(x["base"], far - x["start"]).otherwise(-1))
        reached, coming = scan(ends, _most), F.reverse(scan(F.reverse(nearness), _most))
        return let(F.struct(reached.alias("reached"), coming.alias("coming")), lambda b: F.filter(
            spans, lambda x, i: x["base"] | ((F.get(b["reached"], i) <= x["start"]) & (far - F.get(b["coming"], i) >= x["end"]))
        ))

    return let(whole, proposals)


def _by_start(a: Column, b: Column) -> Column:
    first = F.when(a["start"] != b["start"], a["start"] - b["start"]).when(a["end"] != b["end"], a["end"] - b["end"])
    return first.otherwise(a["kind"] - b["kind"])


# --- reliabilities and classifier --------------------------------------------------------------


@dataclass(frozen=True)
class SpanModel:
    """Logistic weights: of each kind, of each labeler's vote -1, 0 and 1 on each kind, and of each shape."""

    kinds: tuple[float, ...]
    votes: tuple[tuple[tuple[float, float, float], ...], ...]
    shapes: dict[int, float]
    reliabilities: dict[int, tuple[float, ...]]


# What a labeler is taken for at first: right more often than not, which fixes what 0 and 1 mean.
_START = {(1, 1): 2.5, (0, -1): 2.5, (1, 0): 0.5, (0, 0): 0.5, (1, -1): 0.5, (0, 1): 0.5}


def expectation_maximisation(
    patterns: list[tuple[tuple[int, ...], float]], rounds: int = ROUNDS, prior: list[dict] | None = None
):
    """Likelihood of each vote pattern being personal data, how often each labeler that votes is right, and its votes.

    ``patterns`` are votes and their count. Votes are independent given the truth; the start is their majority. A
    labeler's votes are shares by truth and vote, which begin at the counts of ``prior``.
    """
    prior = prior or [_START] * len(VOTERS)
    likely = [min(0.9, max(0.1, 0.5 + 0.2 * sum(votes))) for votes, _ in patterns]
    right, tables = [0.5] * len(VOTERS), []
    for _ in range(rounds):
        positive = sum(p * n for p, (_, n) in zip(likely, patterns)) + 1.0
        negative = sum((1 - p) * n for p, (_, n) in zip(likely, patterns)) + 1.0
        tables = []
        for j in range(len(VOTERS)):
            counts = dict(prior[j])
            for p, (votes, n) in zip(likely, patterns):
                counts[1, votes[j]] += p * n
                counts[0, votes[j]] += (1 - p) * n
            sums = {y: sum(counts[y, v] for v in (-1, 0, 1)) for y in (0, 1)}
            tables.append({key: value / sums[key[0]] for key, value in counts.items()})
            spoken = counts[1, 1] + counts[0, -1] + counts[1, -1] + counts[0, 1]
            right[j] = (counts[1, 1] + counts[0, -1]) / spoken
        likely = []
        for votes, _ in patterns:
            odds = math.log(positive / negative)
            odds += sum(math.log(t[1, v] / t[0, v]) for t, v in zip(tables, votes))
            likely.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return likely, right, tables


def kind_likelihoods(rows: list[tuple[int, tuple[int, ...], float]]) -> tuple[list[float], dict[int, tuple[float, ...]]]:
    """Likelihoods of ``(kind, votes, count)``, and the labelers' reliabilities on each kind.

    A kind's labelers are estimated from its own candidates, beginning at what all candidates say of them.
    """
    _, _, tables = expectation_maximisation([(votes, n) for _, votes, n in rows])
    shared = [{key: PRIOR_ROWS / 2 * value for key, value in table.items()} for table in tables]
    likely, right = [0.0] * len(rows), {}
    for kind in sorted({kind for kind, *_ in rows}):
        own = [i for i, row in enumerate(rows) if row[0] == kind]
        found, reliable, _ = expectation_maximisation([rows[i][1:] for i in own], prior=shared)
        right[kind] = tuple(reliable)
        for i, p in zip(own, found):
            likely[i] = p
    return likely, right


def fit(found: DataFrame) -> SpanModel:
    """Learns from all candidates of ``found (candidates)``; only counts by pattern are collected."""
    spans = found.select(F.explode("candidates").alias("c"))
    counted = spans.groupBy("c.kind", "c.votes", "c.shape", "c.base").agg(F.count("*").alias("n")).collect()
    if not counted:
        return SpanModel((0.0,) * len(KINDS), (((0.0, 0.0, 0.0),) * len(VOTERS),) * len(KINDS), {}, {})
    rows = [(r["kind"], tuple(r["votes"]), r["shape"], float(r["n"])) for r in counted]
    likely, right = kind_likelihoods([(kind, votes, n) for kind, votes, _, n in rows])
    # A base span is personal data by definition.
    likely = [max(p, 0.99) if r["base"] else p for p, r in zip(likely, counted)]
    # A vote has a weight of its own on each kind, and one that all kinds share.
    names = [
        [("kind", kind), ("shape", shape)]
        + [("vote", k, j, v) for j, v in enumerate(votes) for k in (kind, None)]
        for kind, votes, shape, _ in rows
    ]
    weights = {name: 0.0 for own in names for name in own}
    total = sum(n for *_, n in rows)
    for _ in range(400):
        slopes = {name: -0.001 * w for name, w in weights.items()}
        for own, p, (*_, n) in zip(names, likely, rows):
            z = sum(weights[name] for name in own)
            gap = (p - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) * n / total
            for name in own:
                slopes[name] += gap
        for name in weights:
            weights[name] += 2.0 * slopes[name]
    of_vote = lambda k, j, v: weights.get(("vote", k, j, v), 0.0) + weights.get(("vote", None, j, v), 0.0)
    return SpanModel(
        tuple(weights.get(("kind", k), 0.0) for k in range(len(KINDS))),
        tuple(
            tuple(tuple(of_vote(k, j, v) for v in (-1, 0, 1)) for j in range(len(VOTERS))) for k in range(len(KINDS))
        ),
        {name[1]: w for name, w in weights.items() if name[0] == "shape"},
        right,
    )


def accepted(spans: Column, model: SpanModel) -> Column:
    """Base spans, and those that the classifier accepts, by kind and start."""
    constant = lambda values: F.array(*[F.lit(float(v)) for v in values])
    shapes = constant(model.shapes.get(s, 0.0) for s in range(20))
    votes = constant(w for kind in model.votes for table in kind for w in table)

    def chance(x: Column) -> Column:
        z = F.get(constant(model.kinds), x["kind"]) + F.get(shapes, x["shape"])
        for j in range(len(VOTERS)):
            z = z + F.get(votes, (x["kind"] * len(VOTERS) + j) * 3 + F.get(x["votes"], F.lit(j)) + 1)
        return 1 / (1 + F.exp(-z))

    kept = F.filter(spans, lambda x: x["base"] | (chance(x) >= ACCEPT))
    return F.array_sort(F.transform(kept, lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base")
    )))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)`` per row; ``spans`` is ``array<struct<kind, start, end, base>>``."""
    named = picked(docs, id=id_col, text=text_col)
    with scratch(docs.sparkSession) as own:
        found = cut(named.select("id", candidates(F.col("text")).alias("candidates")), "spans")
        return own.result(found.select("id", accepted(F.col("candidates"), fit(found)).alias("spans")))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first is, for all of them."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])

    def between(p: Column, low: Column, high: Column) -> Column:
        """The code points from ``low`` up to ``high``, taken from the pieces that hold them."""
        first, last = F.floor(low / PIECE).cast("int"), F.floor(high / PIECE).cast("int")
        held = F.array_join(F.slice(p["pieces"], first + 1, last - first + 1), "")
        return F.substring(held, low - first * PIECE + 1, high - low)

    def rebuilt(p: Column) -> Column:
        parts = F.transform(p["spans"], lambda x, i: let(F.greatest(F.get(p["reached"], i), F.lit(0)), lambda at: F.when(
            x["start"] >= at, F.concat(between(p, at, x["start"]), F.get(names, x["kind"]))
        ).otherwise("")))
        end = F.array_max(F.transform(p["spans"], lambda x: x["end"]))
        return F.concat(F.array_join(parts, ""), between(p, end, p["length"]))

    def cut_up(ordered: Column) -> Column:
        return let(F.struct(
            ordered.alias("spans"), scan(F.transform(ordered, lambda x: x["end"]), _most).alias("reached"),
            F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("pieces"), F.length(text).alias("length"),
        ), rebuilt)

    return F.when(F.size(spans) > 0, let(ordered, cut_up)).otherwise(text)


def mask_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text masked; the classifier learns from all rows first."""
    text = F.col(f"`{text_col}`")
    with scratch(docs.sparkSession):
        model = fit(cut(docs.select(candidates(text).alias("candidates")).filter(F.size("candidates") > 0), "spans"))
    return docs.withColumn(
        text_col, F.when(text.isNull(), text).otherwise(let(
            F.struct(text.alias("t"), accepted(candidates(text), model).alias("s")), lambda p: masked(p["t"], p["s"])
        ))
    )
