"""Personal data by fixed patterns and by bootstrapped contexts, in DataFrame operations only.

Entities of four kinds are found by their form and are spans. They are seeds too, and so are keys: long tokens in which
letters and digits mix, which are no spans by that alone. Around a seed there are lexical patterns, from wide to narrow:
the two words before it, the last of these, that one with the word after, the word after, and for a token its
first letters and its length (a text's ends count as words, what has a form or a digit as its kind). What else stands in
a pattern is a candidate. A few rounds over the graph of patterns and instances score both: a pattern is as good as the
share of its instances that are believed, an instance as the patterns that bring it up (noisy or). Candidates that are
believed, in patterns that are, become spans: of one of the four kinds, or secrets.

Places come from lengths: the pieces between matches and the matches themselves add up, by a window over the matches
of a text. The regular expressions begin only where a match can begin and never back off, so a text without blanks
costs no more than another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import drop_staged, stage

KINDS = ("email", "ip", "card", "phone")
#: A fifth kind, which only patterns find.
SECRET = "secret"
ALL_KINDS = (*KINDS, SECRET)
_LOCAL, _HOST, _BLANK = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]", r"[^\x20\x09-\x0D]"
#: By kind: the pattern of a match, and what any text with a valid match holds. ``\G`` is where the last match ended.
_FORMS = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]"),
}
#: Blank-separated tokens that hold a digit or an at sign.
_TOKEN = (rf"(?<!{_BLANK})[^\x20\x09-\x0D0-9@]*+[0-9@]{_BLANK}*+", "[0-9@]")
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: A token's label that no blank parts from it, and signs before its first letter or digit.
_LEAD = r"^(?:[^0-9@]*[:=#])?+[^\p{L}\p{N}]*+"
#: A key: its characters, and letters and digits that change twice or more.
_KEY = r"^(?=.*[A-Za-z][0-9]+[A-Za-z]|.*[0-9][A-Za-z]+[0-9])[A-Za-z0-9_+/=-]{16,}$"
#: First letters of a token that name what it is: some letter is no hexadecimal digit.
_AFFIX = r"^(?=[A-Za-z]*[G-Zg-z])(?:[A-Za-z]{2,8}[_-]|[A-Za-z]{4})(?=[A-Za-z0-9_-]{8})"
#: What a candidate must look like to be of a kind.
_SHAPES = {"email": "@", "ip": r"^[^0-9]*+[0-9]++(?:[.:,-][0-9a-f]++){2}", "card": r"^(?:[^0-9]*[0-9]){12,19}[^0-9]*$", "phone": r"^(?:[^0-9]*[0-9]){7,15}[^0-9]*$", SECRET: ".{6}"}
#: Characters kept of the gaps beside a match, earlier matches looked back to, and characters that give a context. Where
#: these hold too few whole words, all of the gap is kept, so that words may be of any length.
REACH, BACK, NEAR = 64, 6, 128
_SPACE, _PLAIN = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D0-9]*\p{L}[^\x20\x09-\x0D0-9]*+"
#: Two whole words after a blank, which no form joins to others as they have letters and no digit.
_TWO_WORDS = rf"(?s){_SPACE}{_PLAIN}{_SPACE}(?:.*{_SPACE})?{_PLAIN}(?:{_SPACE}|$)"
#: A word and a blank after it.
_ENDED = rf"{_BLANK}{_SPACE}"
#: Rounds over the graph; believed values that a pattern needs; share or belief from which one is trusted.
ROUNDS, SUPPORT, BELIEVED = 3, 3, 0.8


def _last(text: Column, size: int) -> Column:
    """The last characters, or the whole text if these do not hold two whole words."""
    return F.when(F.length(text) <= size, text).when(F.right(text, F.lit(size)).rlike(_TWO_WORDS), F.right(text, F.lit(size))).otherwise(text)


def _first(text: Column) -> Column:
    """The first characters, or the whole text if no word ends in these."""
    return F.when(F.length(text) <= REACH, text).when(F.left(text, F.lit(REACH)).rlike(_ENDED), F.left(text, F.lit(REACH))).otherwise(text)


def _matches(kind: str, gaps: Column, found: Column) -> Column:
    """Matches as (kind, order, characters before it since the last match, match, the last of those characters, the
    first after it), from the pieces between matches and the matches."""

    def row(x: Column, i: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), x["m"].alias("match"), _last(x["g"], REACH).alias("near"), _first(x["a"]).alias("after"))

    zipped = F.arrays_zip(gaps.alias("g"), found.alias("m"), F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))).alias("a"))
    return F.transform(F.filter(zipped, lambda x: x["m"].isNotNull()), row)


def _masked(text: Column) -> Column:
    for kind, (pattern, _) in _FORMS.items():
        text = F.regexp_replace(text, pattern, f"<{kind}>")
    return F.lower(F.regexp_replace(text, _TOKEN[0], "<number>"))


def _contexts(near: Column, whole: Column, after: Column, affix: Column) -> Column:
    """Patterns around a match, from wide to narrow; ``whole`` says that ``near`` is all of the text before it."""
    before = _masked(F.regexp_replace(near, r"(?<![\"'(\[{<])[\"'(\[{<]++$", ""))
    # The first word may be cut off, unless the text begins with it; so may the last one after the match.
    words = F.split(F.concat(F.when(whole, F.lit("^ ")).otherwise(F.lit("")), before), r"[\x20\x09-\x0D]++")
    left = F.filter(words, lambda x, i: (x != "") & (whole | (i > 0)))
    rest = _masked(F.regexp_replace(after, r"^[^\p{L}\p{N}\x20\x09-\x0D]++", ""))
    right = F.get(F.filter(F.split(F.concat(rest, F.lit(" $")), r"[\x20\x09-\x0D]++"), lambda x: x != ""), F.lit(0))

    def patterns(w: Column) -> Column:
        two, one = F.array_join(F.slice(w, F.greatest(F.size(w) - 1, F.lit(1)), F.lit(2)), " "), F.coalesce(F.get(w, F.size(w) - 1), F.lit(""))
        beside = F.concat(F.lit("> "), right)
        named = [F.when(c != "", F.concat(F.lit("< "), c)) for c in (two, one)]
        return F.array_compact(F.array_distinct(F.array(*named, F.concat(named[1], F.lit(" "), beside), F.when(right != "$", beside), affix)))

    return F.transform(F.array(left), patterns)[0]


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = back.substr(i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(kind == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(F.lit(False)))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(F.lit(True))
    )


def _fits(value: Column, kind: Column) -> Column:
    return F.coalesce(*(F.when(kind == k, value.rlike(shape)) for k, shape in _SHAPES.items()), F.lit(False))


def _believe(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trusted patterns ``(context, kind)`` and candidates ``(value, kind)`` from distinct ``(context, value, seed,
    token)``, seed being the kind or null; what is a token is a candidate, seed or not."""
    seeds = edges.where("seed is not null").select("context", "value", F.col("seed").alias("kind"), F.lit(1.0).alias("belief"))
    tokens = edges.where("token").select("context", "value", "seed")
    size = edges.groupBy("context").agg(F.count_distinct("value").alias("size"))
    told, patterns, beliefs = seeds, None, None
    for _ in range(ROUNDS):
        before = (patterns, beliefs)
        patterns = told.groupBy("context", "kind").agg(F.sum("belief").alias("sum")).where(F.col("sum") >= SUPPORT)
        patterns = stage(patterns.join(size, "context").select("context", "kind", F.least(F.lit(1.0), F.col("sum") / F.col("size")).alias("score")).where("score >= 0.5"), "patterns")
        brought = tokens.join(patterns, "context").where(_fits(F.col("value"), F.col("kind")))
        beliefs = stage(brought.groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-6), 1 - F.col("score")))))).alias("belief")), "beliefs")
        drop_staged(*before)
        told = seeds.union(tokens.where("seed is null").join(beliefs, "value").select("context", "value", "kind", "belief"))
    return patterns.where(F.col("score") >= BELIEVED).select("context", "kind"), beliefs.where(F.col("belief") >= BELIEVED).select("value", "kind")


def find(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> tuple[DataFrame, DataFrame]:
    """The rows, numbered, ``(row, keep...)``; and the spans ``(row, no, kind, start, end, base)``, in code points
    with the end exclusive, ``no`` the kind's place in ``ALL_KINDS``. ``base`` marks those found by form. Spans of one
    kind do not overlap; learnt ones overlap none by form. Null text: empty, without spans."""
    forms = (*_FORMS.items(), ("token", _TOKEN))
    body = F.coalesce(F.col(text), F.lit(""))
    cut = [c for k, (pattern, needs) in forms for c in (F.when(body.rlike(needs), F.split(body, pattern, -1)).alias(f"g_{k}"), F.when(body.rlike(needs), F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).alias(f"m_{k}"))]
    kept = F.struct(*(F.col(c) for c in keep)).alias("kept")
    pieces = docs.select(kept, *cut)
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,match:string,near:string,after:string>>")
    found = F.concat(*(F.coalesce(_matches(k, F.col(f"g_{k}"), F.col(f"m_{k}")), none) for k, _ in forms))
    # The number is fixed by writing it.
    rows = stage(pieces.select(F.monotonically_increasing_id().alias("row"), "kept.*", found.alias("found")), "matches")
    each = rows.select("row", F.explode("found").alias("m")).select("row", "m.*")
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    n = F.length("match")
    order = Window.partitionBy("row", "kind").orderBy("i")
    back = [c for k in range(BACK, 0, -1) for c in (F.lag("near", k, "").over(order), F.lag("match", k, "").over(order))]
    short = (F.length("after") < REACH) | ~F.col("after").rlike(_ENDED)
    ahead = F.concat("after", F.when(short, F.concat(F.lead("match", 1, "").over(order), F.lead("after", 1, "").over(order))).otherwise(F.lit("")))
    placed = each.withColumn("start", F.coalesce(F.sum(F.col("gap") + n).over(before), F.lit(0)) + F.col("gap"))
    placed = placed.withColumn("near", _last(F.concat(*back, "near"), NEAR)).withColumn("whole", F.length("near") == F.col("start")).withColumn("after", ahead)
    placed = placed.where(_valid(F.col("kind"), F.col("match"))).select("row", "kind", "match", "near", "after", "whole", "start")
    # A token without its label and the signs around it
    token = F.col("kind") == "token"
    lead = F.when(token, F.regexp_extract("match", _LEAD, 0)).otherwise(F.lit(""))
    core = F.regexp_extract(F.substr("match", F.length("lead") + 1), r"[\p{L}\p{N}](?s:.*)[\p{L}\p{N}]|[\p{L}\p{N}]", 0)
    placed = placed.withColumn("lead", lead).withColumn("tail", F.col("match")).withColumn("match", F.when(token, core).otherwise(F.col("match")))
    placed = placed.withColumn("tail", F.substr("tail", F.length("lead") + F.length("match") + 1)).withColumn("start", F.col("start") + F.length("lead")).withColumn("end", F.col("start") + F.length("match"))
    placed = placed.where("end > start")
    placed = placed.withColumn("near", F.concat("near", "lead")).withColumn("after", F.concat("tail", "after")).drop("lead", "tail")
    # Tokens that a span by form overlaps are no candidates: what began before has not ended, or the next begins inside.
    place = Window.partitionBy("row").orderBy("start", F.when(token, 1).otherwise(0))
    own = F.when(~token, F.col("end"))
    nxt = F.when(~token, F.col("start"))
    later = Window.partitionBy("row").orderBy(F.desc("start"), F.when(token, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("reach", F.max(own).over(place.rowsBetween(Window.unboundedPreceding, -1))).withColumn("next", F.min(nxt).over(later))
    free = (F.coalesce(F.col("reach"), F.lit(0)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
    affix = F.when(token & F.col("match").rlike(_AFFIX), F.concat(F.lit("~ "), F.regexp_extract("match", _AFFIX, 0), F.lit(" "), F.length("match")))
    seed = F.when(~token, F.col("kind")).when(F.col("match").rlike(_KEY), SECRET)
    placed = placed.where(~token | free).withColumn("contexts", _contexts(F.col("near"), F.col("whole"), F.col("after"), affix)).withColumn("seed", seed).drop("reach", "next", "near", "after", "whole")
    placed = stage(placed, "placed")
    told = placed.withColumn("context", F.explode("contexts")).withColumn("value", F.lower("match"))
    edges = stage(told.select("context", "value", "seed", token.alias("token")).distinct(), "edges")
    patterns, beliefs = _believe(edges)
    learnt = told.where(token).select("row", "context", "value", "start", "end").join(patterns, "context").join(beliefs, ["value", "kind"])
    no = reduce(lambda c, k: c.when(F.col("kind") == k, ALL_KINDS.index(k)), ALL_KINDS, F.when(F.lit(False), -1))
    spans = placed.where(~token).select("row", "kind", "start", "end", F.lit(True).alias("base")).union(learnt.select("row", "kind", "start", "end", F.lit(False)))
    # A candidate that patterns of several kinds bring up counts as the first.
    first = Window.partitionBy("row", "start", "end", "base").orderBy("no")
    spans = spans.withColumn("no", no).withColumn("rank", F.when(~F.col("base"), F.row_number().over(first)).otherwise(F.lit(1))).where("rank = 1")
    return rows.select("row", *keep), spans.select("row", "no", "kind", "start", "end", "base")


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, ALL_KINDS)), s["no"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_learnt, n_spans)`` of each row; the first counts and
    the digest are of the spans found by form, ``spans`` lists all, secrets last; ``n_learnt`` counts those that patterns
    found. Rows that repeat an id, and null ids, are rows of their own; null text is empty; empty table: no rows. A row's
    spans meet in one row, as its text does."""
    rows, spans = find(docs, text=text, keep=(id_col,))
    s = F.struct("no", "start", "end")
    by_row = spans.groupBy("row").agg(*(F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS), F.sort_array(F.collect_list(F.when(F.col("base"), s))).alias("base"), F.sort_array(F.collect_list(s)).alias("all"), F.count_if(~F.col("base")).alias("n_learnt"), F.count("*").alias("n_spans"))
    out = rows.join(by_row, "row", "left")
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select(id_col, *counts, F.sha2(F.coalesce(_joined(F.col("base")), F.lit("")), 256).alias("base_sha256"), F.coalesce(_joined(F.col("all")), F.lit("")).alias("spans"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_learnt", "n_spans")))


def redact(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets. Spans that overlap are
    replaced as one, by the kind of the one that starts first, and of those the longest. Null texts stay null; all other columns stay."""
    columns = docs.columns
    whole = docs.select(F.struct(*columns).alias("doc"), F.col(text).alias("body"))
    rows, spans = find(whole, text="body", keep=("doc",))
    order = Window.partitionBy("row").orderBy("start", F.desc("end"), "no")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((reach <= F.col("start")).cast("int"), F.lit(1))
    islands = spans.withColumn("begins", begins).withColumn("island", F.sum("begins").over(order))
    named = F.max(F.when(F.col("begins") == 1, F.col("kind"))).alias("kind")
    merged = islands.groupBy("row", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), named)
    by_row = merged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    body = F.col("doc")[text]

    def piece(cut: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.element_at("cuts", F.greatest(i, F.lit(1)))["end"])
        return F.concat(F.substring(body, start + 1, cut["start"] - start), F.lit("<"), F.upper(cut["kind"]), F.lit(">"))

    last = F.element_at("cuts", -1)["end"]
    clean = F.concat(F.concat_ws("", F.transform("cuts", piece)), F.substring(body, last + 1, F.length(body)))
    out = rows.join(by_row, "row", "left").withColumn("clean", F.when(F.col("cuts").isNull(), body).otherwise(clean))
    return out.select(*(F.col("clean").alias(c) if c == text else F.col("doc")[c].alias(c) for c in columns))
