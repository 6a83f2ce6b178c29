"""Personal data by weak supervision, with native expressions only.

Four base patterns give spans that always stay. A second, looser pattern proposes more candidates:
written-out addresses, numbers without a country code, bare account numbers, credentials. Every
candidate is voted on by labelers that look at different things and may abstain: the regular
shape, gazetteers of words, the words before it and what surrounds it. Expectation-maximisation
estimates each labeler's reliability from the counts of vote patterns (a few rows), without
labels. The posteriors then train the final span classifier, a logistic model over features of
the span and its surroundings, again from counts of feature patterns. Candidates it accepts are
added to the base spans.

Positions: the pieces between matches (``split``) and the matches (``regexp_extract_all``) add up
to the text, so running lengths in code points give the spans. Running values are built in blocks
(``running``) and texts are cut in blocks (``redact``), so a text with hundreds of thousands of matches
takes time in proportion to them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from coursewise.sources.staging import staged

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
#: The base patterns; possessive forms and the look-behinds only spare retries that cannot match.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRIGGERS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": r"\+[0-9]"}
LOOSE_TRIGGER = r"[0-9][0-9]|AKIA|[(\[]at[)\]]|passw|token|secret|api_key"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: A credential of any length, with inner dots and with padding at the end of its parts.
_KEY = r"[A-Za-z0-9_+/-](?:[A-Za-z0-9_+/-]|\.(?=[A-Za-z0-9_+/-])|=++(?=[A-Za-z0-9_+/.-])){11,}+=*+"
#: What the method may add: kind and shape. The shapes are tried in this order at each place.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{2,}+)++",
    "secret": rf"\b(?:AKIA[0-9A-Z]{{16}}\b|(?:password|passwd|token|api_key|secret)(?: ?[=:] ?)\"?{_KEY})",
    "id": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b|\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}\b",
    "phone": r"(?<![0-9+.])(?:00[1-9][0-9]{0,2}[ -])?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}(?![0-9])",
}
ADDED = ("email", "secret", "id", "phone")
CONTEXT = 40  # code points kept before a candidate

Text = Column
BLOCK = 512  # elements of an array whose running values are built together


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def in_blocks(values: Column, of_block: Callable[[Column], Column]) -> Column:
    """``of_block`` of each BLOCK elements of a bound array, in order."""
    count = F.ceil(F.size(values) / BLOCK).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda b: of_block(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))


def running(values: Column, merge: Callable[[Column, Column], Column], start: int) -> Column:
    """The running values of an array of ints, each element merged into what came before it.

    An append copies what is there, so a block is run through on its own from the value that the
    blocks before it end with.
    """

    def walk(block: Column, first: Column) -> Column:
        none = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            return let(merge(acc["at"], x), lambda at: F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out")))

        return F.aggregate(block, none, step, lambda acc: acc["out"])

    def whole(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(start), merge))
        before = let(totals, lambda t: F.concat(F.array(F.lit(start)), F.flatten(in_blocks(t, lambda part: part))))
        firsts = let(before, lambda t: walk(t, F.lit(start)))
        return F.flatten(F.zip_with(blocks, F.slice(firsts, 1, F.size(blocks)), walk))

    return let(values, lambda v: let(in_blocks(v, lambda block: block), whole))


def spans(text: Text, pattern: str, trigger: str) -> Column:
    """array<struct<start,end,value,before>> of the leftmost non-overlapping matches.

    A text without the ``trigger`` has no match; most texts are spared the dearer patterns so.
    """
    none = F.array().cast("array<struct<start:int,end:int,value:string,before:string>>")

    def pairs(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        return F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("value")))

    def placed_pairs(matched: Column) -> Column:
        ends = running(F.transform(matched, lambda x: F.length(x["gap"]) + F.length(x["value"])), lambda a, x: a + x, 0)
        return F.zip_with(
            matched,
            ends,
            lambda x, end: F.struct(
                (end - F.length(x["value"])).alias("start"), end.alias("end"), x["value"].alias("value"),
                F.right(x["gap"], F.lit(CONTEXT)).alias("before"),
            ),
        )

    walked = let(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), pairs), placed_pairs)
    return F.when(text.rlike(trigger), walked).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    backwards = F.split(F.reverse(number), "")

    def worth(x: Column, i: Column) -> Column:
        d = x.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.transform(backwards, worth), F.lit(0), lambda s, x: s + x)
    return F.length(number).between(12, 19) & (F.when(F.length(number).between(12, 19), total) % 10 == 0)


HOLDS = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: x["value"].rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"),
    "card": lambda x: F.coalesce(passes_luhn(digits(x["value"])), F.lit(False)),
    "phone": lambda x: F.length(digits(x["value"])).between(9, 15),
}


def base_spans(text: Text) -> dict[str, Column]:
    """By kind, array<struct<start,end>>; a match that fails its test is dropped."""
    out = {}
    for kind in KINDS:
        held = F.filter(spans(text, PATTERNS[kind], TRIGGERS[kind]), HOLDS[kind])
        out[kind] = F.transform(held, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return out


# --- candidates, votes and features ---------------------------------------------------------


def kind_of(value: Column) -> Column:
    case = F.when(value.rlike(rf"^(?:{LOOSE['secret']})$"), "secret").when(value.rlike(r"^[^a-z]*+[a-z].*(?:at[)\]])"), "email")
    return case.when(value.rlike(rf"^(?:{LOOSE['id']})$"), "id").otherwise("phone")


#: Labelers: for each, tests (for, against) on value and the text before. No test: it abstains.
LABELERS = {
    "shape": (
        lambda v, b: v.rlike(r"^AKIA|^(?:password|passwd|token|api_key|secret) ?[=:] ?\"?(?=[A-Za-z_+/.=-]*[0-9])[A-Za-z0-9_+/.=-]{16,}|@|\(at\)|\[at\]|^[0-9]{3}-[0-9]{2}-[0-9]{4}$|^\(?[2-9][0-9]{2}\)?[ -]"),
        lambda v, b: v.rlike(r"^(?:000|666|9[0-9]{2})-|^\(?0{3}|[=:] ?\"?(?:x+|\*+|0+)$"),
    ),
    "gazetteer": (
        lambda v, b: v.rlike(r"(?i)\b(?:com|org|net|edu|example|gmail|mail)\b|^(?:password|passwd|token|api_key|secret)\b|^AKIA|[ (-]555[ -]"),
        lambda v, b: v.rlike(r"(?i)\b(?:todo|changeme|placeholder|sample|dummy)\b"),
    ),
    "context": (
        lambda v, b: b.rlike(r"(?i)(?:tel|phone|call|fax|mobile|mail|contact|write to|ssn|social|iban|account|key|login|user|pwd)\W{0,3}(?:\w{1,12}\W{1,3}){0,2}$"),
        lambda v, b: b.rlike(r"(?i)(?:isbn|issn|doi|version|part no|page|pp|figure|order)\W{0,3}$"),
    ),
    "randomness": (
        # letters and digits that alternate as in no word; possessive, as a value may be of any length
        lambda v, b: v.rlike(r"[0-9][a-fA-F]++(?:[0-9]++[a-fA-F]++){3}|[A-Z][0-9]++[A-Z]++[0-9]"),
        lambda v, b: v.rlike(r"^[^0-9]*$") & ~v.rlike(r"[@(\[]"),
    ),
}
#: Binary features of the final classifier.
FEATURES = {
    "has_letters": lambda v, b: v.rlike("[A-Za-z]"),
    "mixed": lambda v, b: v.rlike("^(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])"),
    "long": lambda v, b: F.length(v) >= 20,
    "assigned": lambda v, b: v.rlike("[=:]"),
    "at_sign": lambda v, b: v.rlike(r"at[)\]]"),
    "grouped": lambda v, b: v.rlike("[0-9][ -][0-9]"),
    "after_word": lambda v, b: b.rlike(r"[A-Za-z]\W{1,3}$"),
    "many_kinds": lambda v, b: v.rlike("(?:[0-9][A-Za-z]++){3}|^AKIA"),
}


def candidates(text: Text) -> Column:
    """array<struct<start,end,kind,votes,features>>; votes has 1, 0 or - for each labeler."""
    shape = "|".join(f"(?:{p})" for p in LOOSE.values())

    def described(x: Column) -> Column:
        v, b = x["value"], x["before"]
        votes = [F.when(yes(v, b), "1").when(no(v, b), "0").otherwise("-") for yes, no in LABELERS.values()]
        flags = [F.when(test(v, b), "1").otherwise("0") for test in FEATURES.values()]
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), kind_of(v).alias("kind"),
            F.concat(*votes).alias("votes"), F.concat(*flags).alias("features"),
        )

    return F.transform(spans(text, shape, LOOSE_TRIGGER), described)


def estimate(patterns: dict[str, int], rounds: int = 50) -> dict[str, float]:
    """Expectation-maximisation over vote patterns: the posterior of each.

    A labeler has its own chance to vote for and against in true and in other spans; it starts as
    better than a coin, and one count is added to each cell so that no chance becomes zero.
    """
    size = len(next(iter(patterns), ""))
    prior = 0.5
    chance = [{1: {"1": 0.6, "0": 0.1, "-": 0.3}, 0: {"1": 0.1, "0": 0.6, "-": 0.3}} for _ in range(size)]
    posterior: dict[str, float] = {}
    for _ in range(rounds):
        for p in patterns:
            yes = prior * math.prod(chance[i][1][c] for i, c in enumerate(p))
            no = (1 - prior) * math.prod(chance[i][0][c] for i, c in enumerate(p))
            posterior[p] = yes / (yes + no)
        total = sum(patterns.values())
        mass = {1: sum(n * posterior[p] for p, n in patterns.items())}
        mass[0] = total - mass[1]
        prior = min(0.99, max(0.01, (mass[1] + 1) / (total + 2)))
        for i in range(size):
            for truth in (1, 0):
                for c in "10-":
                    n = sum(m * (posterior[p] if truth else 1 - posterior[p]) for p, m in patterns.items() if p[i] == c)
                    start = {"1": 6, "0": 1, "-": 3} if truth else {"1": 1, "0": 6, "-": 3}  # a weak opinion to start from
                    chance[i][truth][c] = (n + start[c]) / (mass[truth] + 10)
    return posterior


def fit_classifier(rows: list[tuple[str, float, float]], steps: int = 400, rate: float = 0.5, l2: float = 1e-3) -> list[float]:
    """Logistic weights (offset first) from rows (features, share of true spans, count)."""
    size = len(FEATURES)
    weights = [0.0] * (size + 1)
    total = sum(n for _, _, n in rows) or 1
    for _ in range(steps):
        slope = [l2 * w for w in weights]
        for features, share, n in rows:
            p = 1 / (1 + math.exp(-weights[0] - sum(w for w, c in zip(weights[1:], features, strict=True) if c == "1")))
            error = (p - share) * n / total
            slope[0] += error
            for i, c in enumerate(features):
                if c == "1":
                    slope[i + 1] += error
        weights = [w - rate * s for w, s in zip(weights, slope, strict=True)]
    return weights


def train(found: DataFrame) -> list[float]:
    """Weights of the classifier from a frame with the column ``candidates`` of all documents.

    What reaches the driver are counts by vote and feature pattern: at most 3^labelers times
    2^features rows, however many documents there are.
    """
    counts = (
        found.select(F.explode("candidates").alias("c")).groupBy("c.votes", "c.features").agg(F.count(F.lit(1)).alias("n"))
    )
    rows = sorted(tuple(r) for r in counts.collect())
    votes: dict[str, int] = {}
    for v, _, n in rows:
        votes[v] = votes.get(v, 0) + n
    posterior = estimate(votes)
    return fit_classifier([(f, posterior[v], float(n)) for v, f, n in rows])


def clear_of(found: Column, base: Column) -> Column:
    """The elements of ``found`` that overlap no span of ``base``; both are sorted by start.

    In the order of all starts, what ends last before a candidate and what starts first after it
    are running values.
    """
    none = 2**31 - 1
    of_base = F.transform(base, lambda x: F.struct(x["start"].alias("start"), F.lit(0).alias("n"), x["end"].alias("end")))

    def marked(both: Column) -> Column:
        last = running(F.transform(both, lambda x: F.when(x["n"] == 0, x["end"]).otherwise(-1)), lambda a, x: F.greatest(a, x), -1)
        backwards = F.transform(F.reverse(both), lambda x: F.when(x["n"] == 0, x["start"]).otherwise(none))
        following = F.reverse(running(backwards, lambda a, x: F.least(a, x), none))
        around = F.zip_with(last, following, lambda a, b: F.struct(a.alias("last"), b.alias("next")))
        free = F.zip_with(both, around, lambda x, y: F.struct((x["n"] - 1).alias("n"), ((x["n"] > 0) & (y["last"] <= x["start"]) & (y["next"] >= x["end"])).alias("free")))
        return F.transform(F.array_sort(F.filter(free, lambda x: x["n"] >= 0)), lambda x: x["free"])

    def kept(held: Column) -> Column:
        numbered = F.transform(held, lambda x, i: F.struct(x["start"].alias("start"), (i + 1).alias("n"), x["end"].alias("end")))
        free = let(F.array_sort(F.concat(of_base, numbered)), marked)
        pairs = F.zip_with(held, free, lambda x, f: F.struct(x.alias("x"), f.alias("free")))
        return F.transform(F.filter(pairs, lambda p: p["free"]), lambda p: p["x"])

    return F.when((F.size(found) > 0) & (F.size(base) > 0), let(found, kept)).otherwise(found)


def accepted(found: Column, base: Column, weights: list[float]) -> Column:
    """Candidates the classifier accepts that overlap no base span."""

    def good(x: Column) -> Column:
        parts = [F.when(F.substring(x["features"], i + 1, 1) == "1", w).otherwise(0.0) for i, w in enumerate(weights[1:])]
        return reduce(lambda a, b: a + b, parts, F.lit(weights[0])) >= 0

    return clear_of(F.filter(found, good), base)


def placed(arrays: dict[str, Column], order: tuple[str, ...]) -> Column:
    """array<struct<start,kind number,end,kind>> of several kinds, in order of start, then kind."""
    def tagged(kind: str) -> Column:
        number = F.lit(order.index(kind))
        return F.transform(
            arrays[kind],
            lambda x: F.struct(x["start"].alias("start"), number.alias("n"), x["end"].alias("end"), F.lit(kind).alias("kind")),
        )

    return F.array_sort(F.concat(*map(tagged, arrays)))


def written(ordered: Column) -> Column:
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


ORDER = (*KINDS, "secret", "id")


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base (ordered base spans) and candidates of every whole text; null is empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", placed(base_spans(text), KINDS).alias("base"), candidates(text).alias("candidates"))


def all_spans(base: Column, found: Column, weights: list[float]) -> Column:
    extra = accepted(found, base, weights)
    numbers = F.create_map(*[F.lit(x) for pair in ((k, i) for i, k in enumerate(ORDER)) for x in pair])
    more = F.transform(extra, lambda x: F.struct(x["start"].alias("start"), numbers[x["kind"]].alias("n"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.array_sort(F.concat(base, more))


def pii_table(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and digest are of the base spans; ``spans`` lists base and added ones. Null and empty
    texts have none. Repeated rows come out repeated; other columns are not read.
    """
    found = staged(found_spans(docs), "pii-spans")
    weights = train(found)
    base = F.col("base")
    of_kind = F.transform(base, lambda x: x["kind"])
    counts = [(F.size(of_kind) - F.size(F.array_remove(of_kind, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    every = written(all_spans(base, F.col("candidates"), weights))
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), every.alias("spans"))


def redact(text: Text, ordered: Column) -> Column:
    """The text with each span replaced by its kind; what overlaps an earlier span goes with it."""

    def cut(text: Column, first: Column, end: Column) -> Column:
        return F.substr(text, first + 1, end - first)

    def block_text(block: Column) -> Column:
        low = F.get(block, F.lit(0))["after"]
        part = cut(text, low, F.element_at(block, -1)["start"])  # a block's text is cut once from the whole
        join = lambda part, low: F.transform(
            block, lambda x: F.concat(cut(part, x["after"] - low, x["start"] - low), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        )
        return let(F.struct(part.alias("part"), low.alias("low")), lambda p: F.array_join(join(p["part"], p["low"]), ""))

    def whole(spans: Column) -> Column:
        ends = running(F.transform(spans, lambda x: x["end"]), lambda a, x: F.greatest(a, x), 0)

        def replaced(ends: Column) -> Column:
            before = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
            kept = F.filter(
                F.zip_with(spans, before, lambda x, a: F.struct(a.alias("after"), x["start"].alias("start"), x["kind"].alias("kind"))),
                lambda x: x["start"] >= x["after"],
            )
            body = let(kept, lambda k: F.array_join(in_blocks(k, block_text), ""))
            return F.concat(body, cut(text, F.element_at(ends, -1), F.length(text)))

        return let(ends, replaced)

    return F.when(F.size(ordered) > 0, let(ordered, whole)).otherwise(text)


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents in their own columns, spans replaced by their kinds, n_chars adjusted if there."""
    weights = train(found_spans(docs).select("candidates"))
    text = F.coalesce("text", F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # whatever the columns are called
    marked = docs.select(row, placed(base_spans(text), KINDS).alias("base"), candidates(text).alias("found"))
    spans_of_row = all_spans(F.col("base"), F.col("found"), weights)
    clean = F.when(F.col("row.text").isNotNull(), redact(F.col("row.text"), spans_of_row))
    out = marked.select("row", clean.alias("clean"))
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        length = F.length("clean").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.coalesce(length, F.col("row.n_chars"))
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
