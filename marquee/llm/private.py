"""Personal data: fixed forms, and identifiers found through the contexts of known ones.

Only DataFrame functions are used. E-mail addresses, IP addresses, card and phone numbers are matched by
their forms. They seed a bootstrap: the words around them (left word, left and right word, or a
name with ``=`` or ``:`` at the front of the token) are patterns, the tokens with a digit or ``@`` that
stand in them are instances. Number tokens that follow each other behind single blanks, such as the groups of
a card or phone number, are one instance, written as its digits. Pattern and instance confidences are computed from each other
over the graph of distinct pattern-instance pairs for a few rounds, and tokens that confident
patterns agree on become further spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import free_name, prepare
from marquee.session import materialise

KINDS = ("email", "ip", "card", "phone")
# The forms as given, in a shape that needs linear time and no recursion: runs are possessive and
# begin where a run can begin, and separators that cannot be part of a match are blanked out
# beforehand by one other character each, which keeps all places.
_LABEL = "A-Za-z0-9-"
LOOSE_DOT = rf"(?<![{_LABEL}])\.|\.(?![{_LABEL}])"  # becomes _: part of a name, not of a domain
EMAIL = rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[{_LABEL}]++\.[{_LABEL}.]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
LOOSE_GAP = r"(?<![0-9])[ -]|[ -](?![0-9])"  # becomes x: no part of a number
CARD = r"[0-9][0-9 -]++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_VALID = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"

_BLANK = r"\x20\x09-\x0D"
TOKEN = rf"(?<![^{_BLANK}])[^{_BLANK}0-9@]*+[0-9@][^{_BLANK}]*+"
# The last and the first word of what lies between two tokens, however long it is; each word is tried once.
LAST = rf"(?<![^{_BLANK}])([^{_BLANK}]++)[{_BLANK}]*+$"
FIRST = rf"^[{_BLANK}]*+([^{_BLANK}]++)"
NEAR = 64  # characters that are looked at first; where they hold no whole word, all of the gap is
NEAR_LAST, NEAR_FIRST = rf"[{_BLANK}]([^{_BLANK}]++)[{_BLANK}]*+$", rf"^[{_BLANK}]*+([^{_BLANK}]++)[{_BLANK}]"
NUMBER = r"""^[(+]*[0-9][0-9().+-]*["',;:!?\]}>]*$"""
GOES_ON = r"[0-9)]$"  # a number token that the next one may continue
ROUNDS, LEAST_SEEDS, CONFIDENT = 3, 3, 0.8


def _found(text: Column, pattern: str) -> Column:
    """Matches in order, and the lengths of the text before, between and behind them."""
    return F.struct(
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))


def _only_if(present: Column, found: Column) -> Column:
    """Null, which has no match, where a character that every match needs is absent."""
    return F.when(present, found)


def _tokens(text: Column) -> Column:
    """Tokens with a digit or @, and of each stretch between them its length, last word and first word."""
    def word(g: Column, near: Column, whole_in: str, anywhere: str) -> Column:
        hit = F.regexp_extract(near, whole_in, 1)
        return F.lower(F.when(hit != "", hit).otherwise(F.regexp_extract(g, anywhere, 1)))

    about = F.transform(F.split(text, TOKEN, -1), lambda g: F.struct(
        F.length(g).alias("size"), (g == " ").alias("single"),
        word(g, F.right(g, F.lit(NEAR)), NEAR_LAST, LAST).alias("last"), word(g, F.left(g, F.lit(NEAR)), NEAR_FIRST, FIRST).alias("first")))
    return F.struct(about.alias("gaps"), F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)).alias("hits"))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(back, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def scan(docs: DataFrame, carry: Sequence[str], row: str) -> DataFrame:
    """The one pass over the texts: per row the matches of each form and the tokens, stored."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digit = text.rlike("[0-9]")
    found = docs.select(
        *carry,
        _only_if(text.contains("@"), _found(F.regexp_replace(text, LOOSE_DOT, "_"), EMAIL)).alias("email_"),
        _only_if(digit & text.contains("."), _found(text, IP)).alias("ip_"),
        _only_if(digit, _found(F.regexp_replace(text, LOOSE_GAP, "x"), CARD)).alias("card_"),
        _only_if(digit & text.contains("+"), _found(text, PHONE)).alias("phone_"),
        _only_if(digit | text.contains("@"), _tokens(text)).alias("tokens_"),
        F.monotonically_increasing_id().alias(row))
    return materialise(found, "matches")


def _placed(found: DataFrame, row: str, column: str, size: Column) -> DataFrame:
    """One row per match: row, at, hit, gap (what lies before it), next_gap, start, end in characters."""
    each = found.where(F.size(f"{column}.hits") > 0).select(row, F.col(f"{column}.gaps").alias("gaps"),
                                                            F.posexplode(f"{column}.hits").alias("at", "hit"))
    each = each.select(row, "at", "hit", F.get("gaps", F.col("at")).alias("gap"), F.get("gaps", F.col("at") + 1).alias("next_gap"))
    so_far = Window.partitionBy(row).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(size + F.length("hit")).over(so_far)
    return each.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit"))


def base_spans(found: DataFrame, row: str) -> DataFrame:
    """(row, kind, start, end) of the fixed forms; kind is the place in ``KINDS``."""
    digits = F.regexp_replace("hit", "[^0-9]", "")
    count = F.length(digits)
    valid = {
        "email": F.lit(True),
        "ip": F.col("hit").rlike(IP_VALID),
        "card": F.when(count.between(13, 19), _luhn(digits)).otherwise(False),
        "phone": count.between(9, 15),
    }
    parts = [
        _placed(found, row, f"{kind}_", F.col("gap")).where(valid[kind]).select(
            row, F.lit(i).alias("kind"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
        for i, kind in enumerate(KINDS)
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


def candidates(found: DataFrame, row: str) -> DataFrame:
    """(row, start, end, instance, patterns): tokens without the punctuation around them, and their contexts.

    A run of number tokens is one candidate, and its context is what stands around the whole run. Its instance is
    its digits and points, so that one number written in two ways is one instance.
    """
    placed = _placed(found, row, "tokens_", F.col("gap.size"))
    named = F.regexp_extract("hit", r"^([A-Za-z_][A-Za-z0-9_-]*[=:])[^/]", 1)
    lead = F.when(named != "", F.length(named)).otherwise(0)
    body = F.substring("hit", lead + 1, F.length("hit"))
    head = F.length(F.regexp_extract(body, r"""^(["'(\[<{]*)""", 1))
    inner = F.substring(body, head + 1, F.length(body))
    kept = F.regexp_replace(inner, r"""["')\]>}.,;:!?]+$""", "")
    start = F.col("start") + lead + head
    number = body.rlike(NUMBER)
    each = placed.select(
        row, "at", start.cast("long").alias("start"), (start + F.length(kept)).cast("long").alias("end"), kept.alias("kept"),
        F.lower(named).alias("named"), number.alias("number"), (number & body.rlike(GOES_ON)).alias("goes_on"),
        F.col("gap.single").alias("single"), F.col("gap.last").alias("left"), F.col("next_gap.first").alias("right"))
    order = Window.partitionBy(row).orderBy("at")
    joins = F.col("number") & (F.col("named") == "") & F.col("single") & F.coalesce(F.lag("goes_on").over(order), F.lit(False))
    runs = each.withColumn("begins", F.when(joins, 0).otherwise(1)).withColumn(
        "run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = runs.groupBy(row, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.bool_and("number").alias("number"),
        F.min(F.struct("at", "named", "left")).alias("first"), F.max(F.struct("at", "right")).alias("last"),
        F.sort_array(F.collect_list(F.struct("at", "kept"))).alias("parts"))
    text = F.array_join(F.col("parts.kept"), " ")
    instance = F.when(F.col("number"), F.regexp_replace(text, "[^0-9.]", "")).otherwise(text)
    named, left, right = F.col("first.named"), F.col("first.left"), F.col("last.right")
    patterns = F.array(
        F.when(named != "", F.concat(F.lit("n "), named)),
        F.when((named == "") & (left != ""), F.concat(F.lit("l "), left)),
        F.when((named == "") & (left != "") & (right != ""), F.concat(F.lit("b "), left, F.lit(" "), right)))
    return runs.select(row, "start", "end", instance.alias("instance"), F.array_compact(patterns).alias("patterns")).where("instance <> ''")


def discovered(
    tokens: DataFrame, spans: DataFrame, row: str,
    rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, confident: float = CONFIDENT,
) -> DataFrame:
    """(row, kind, start, end) of tokens that confident patterns mark and no fixed form covers.

    A token, or run of number tokens, that a span begins in is a seed of its kind. A pattern's confidence for a kind is the sum
    of its instances' confidences over their number plus one; it counts from ``least_seeds`` distinct
    seeds and ``confident`` up. An instance is as sure as the best agreement of its patterns, one minus the
    product of their doubts. Copies of a document add nothing: pairs are counted once.
    """
    own = spans.select(F.col(row).alias("r_"), F.col("kind").alias("k_"), F.col("start").alias("s_"), F.col("end").alias("e_"))
    # Both sides hold only the tokens and spans of one row at a time.
    meets = (F.col(row) == F.col("r_")) & (F.col("start") < F.col("e_")) & (F.col("end") > F.col("s_"))
    marked = tokens.join(own, meets, "left").select(
        row, "start", "end", "instance", "patterns", F.col("k_").isNotNull().alias("covered"),
        F.when(F.col("s_").between(F.col("start"), F.col("end") - 1), F.col("k_")).alias("kind"))
    marked = materialise(marked, "tokens")
    # Inside a span only its beginning counts.
    usable = marked.where("NOT covered OR kind IS NOT NULL")
    pairs = materialise(
        usable.select("instance", F.explode("patterns").alias("pattern")).distinct(), "pairs")
    seeds = materialise(usable.where("kind IS NOT NULL").select("instance", "kind").distinct(), "seeds")
    number = pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("number"))
    sure = seeds.select("instance", "kind", F.lit(1.0).alias("sure"), F.lit(1).alias("seed"))
    for _ in range(rounds):
        backed = pairs.join(sure, "instance").groupBy("pattern", "kind").agg(
            F.sum("sure").alias("total"), F.sum("seed").alias("seeds"))
        trusted = backed.join(number, "pattern").select(
            "pattern", "kind", (F.col("total") / (F.col("number") + 1)).alias("trust"), "seeds",
        ).where((F.col("trust") >= confident) & (F.col("seeds") >= least_seeds))
        told = pairs.join(trusted, "pattern").groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999999)))))).alias("sure"))
        told = told.join(seeds, ["instance", "kind"], "left_anti").select("instance", "kind", "sure", F.lit(0).alias("seed"))
        sure = materialise(sure.where("seed = 1").unionAll(told), "sure")
    best = sure.where((F.col("seed") == 0) & (F.col("sure") >= confident)).groupBy("instance").agg(
        F.max(F.struct("sure", -F.col("kind"))).alias("best"))
    named = best.select("instance", (-F.col("best").getField("col2")).alias("kind"))
    return marked.where("NOT covered").select(row, "start", "end", "instance").join(named, "instance").select(
        row, "kind", "start", "end").distinct()


def personal_data(docs: DataFrame, carry: Sequence[str] = ("doc_id",), **options: float) -> DataFrame:
    """One row per row of ``docs``: the carried columns, n_email, n_ip, n_card, n_phone, base_sha256,
    spans, n_added.

    Spans are ``kind:start:end`` in code points, end exclusive, ordered by kind as in ``KINDS`` and
    then by place, comma-joined; base_sha256 is the SHA-256 of the list of the fixed forms alone, which
    the counts count too. Null counts as the empty text, which has no span. Rows that repeat an id
    or a text are judged each; ids may be null; extra columns are ignored unless carried; an empty
    table gives an empty result. The tokens of one text pass through one task, as its text does.
    """
    prepare(docs.sparkSession)
    row = free_name(docs, "row_")
    found = scan(docs, carry, row)
    spans = materialise(base_spans(found, row), "spans")
    added = discovered(candidates(found, row), spans, row, **options)
    every = spans.withColumn("base", F.lit(True)).unionAll(added.select(row, "kind", "start", "end").withColumn("base", F.lit(False)))
    name = F.array(*[F.lit(k) for k in KINDS])

    def listed(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")

    part = F.struct("kind", "start", "end")
    per_row = every.groupBy(F.col(row).alias("r_")).agg(
        *[F.count_if(F.col("base") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.array_sort(F.collect_list(F.when(F.col("base"), part))).alias("own"),
        F.array_sort(F.collect_list(part)).alias("all"))
    joined = found.select(*carry, row).join(per_row, F.col(row) == F.col("r_"), "left")
    none = F.lit("")
    return joined.select(
        *[F.col(c) for c in carry],
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(listed(F.col("own")), none), 256).alias("base_sha256"),
        F.coalesce(listed(F.col("all")), none).alias("spans"),
        F.coalesce((F.size("all") - F.size("own")).cast("long"), F.lit(0).cast("long")).alias("n_added"))
