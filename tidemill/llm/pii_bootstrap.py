"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Plain patterns find e-mail addresses, IP addresses, card numbers and phone numbers: the seeds. The words around seeds induce
lexical patterns (a label such as "phone:", or the three words ahead, or the word ahead with the word behind). Patterns and
identifier-like tokens form a graph that is scored in rounds: a pattern by how many of its tokens are known, a token
by the patterns that hold it. Tokens that confident patterns agree on, and that no plain pattern finds, are reported as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.stage import drop, settle

#: Rounds of scoring; least known tokens and least score of a pattern; least score of a token.
ROUNDS, LEAST_KNOWN, LEAST_PATTERN, LEAST_TOKEN = 3, 3, 0.6, 0.6
KINDS = ("email", "ip", "card", "phone")
# The plain patterns. Possessive and anchored at the start of a run of their first characters (or at the end of the last
# match), which finds the same spans without trying every place of a long run and without recursion.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_INK, _GAP = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
#: An identifier-like token: a run of other than white space with an at sign or six digits.
_TOKEN = rf"(?<!{_INK})(?=[^\x20\x09-\x0D@]*+@|(?:[^\x20\x09-\x0D0-9]*+[0-9]){{6}}){_INK}++"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, F.char_length(digits) - i + 1, F.lit(1))) - 48
        return total + F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _valid(rank: Column, value: Column) -> Column:
    """Whether a match is one of its kind (by its place in KINDS; tokens always are)."""
    byte = "^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    digits = _digits(value)
    return (
        F.when(rank == 1, F.forall(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")).rlike(byte)))
        .when(rank == 2, F.when(F.char_length(digits).between(14, 19), _luhn(digits)).otherwise(False))
        .when(rank == 3, F.char_length(digits).between(10, 15))
        .otherwise(True)
    )


def _around(part: Column, n: int) -> Column:
    """The last n words of a piece of text, one space between them; empty if it has fewer."""
    found = F.regexp_extract(part, rf"(?<!{_INK})(?:{_INK}++{_GAP}++){{{n - 1}}}{_INK}++{_GAP}*+$", 0)
    return F.trim(F.regexp_replace(found, rf"{_GAP}+", " "))


def _matches(docs: DataFrame) -> DataFrame:
    """All matches of every row as an array, without its text: kind, place among its kind, code points since the match before, length, value, and the
    words around it (up to the matches of its kind beside it), in lower case."""
    text, held = F.col("text"), []
    for rank, (kind, pattern) in enumerate(zip((*KINDS, "token"), (_EMAIL, _IP, _CARD, _PHONE, _TOKEN), strict=True)):
        gate = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, text.rlike("[0-9@]"))
        docs = docs.withColumn(f"{kind}_hits", F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
        docs = docs.withColumn(f"{kind}_parts", F.when(F.size(f"{kind}_hits") > 0, F.split(text, pattern, -1)))

        def one(hit: Column, i: Column, rank: int = rank, kind: str = kind) -> Column:
            ahead, behind = F.lower(F.get(f"{kind}_parts", i)), F.lower(F.get(f"{kind}_parts", i + 1))
            return F.struct(
                F.lit(rank).alias("rank"), i.alias("i"), F.char_length(F.get(f"{kind}_parts", i)).alias("gap"), F.char_length(hit).alias("size"), hit.alias("value"),
                _around(ahead, 1).alias("one"), _around(ahead, 3).alias("three"), F.regexp_extract(behind, rf"^{_GAP}++({_INK}++)", 1).alias("after"),
            )

        held.append(_indexed(f"{kind}_hits", one))
    return docs.select("row", "doc_id", F.concat(*held).alias("found"))


def _indexed(hits: str, one: Callable[[Column, Column], Column]) -> Column:
    return F.transform(F.col(hits), lambda hit, i: one(hit, i))


def _spans(found: DataFrame) -> DataFrame:
    """One row for each valid match (row, rank, from, to, value as a digest, and the words around); tokens that overlap a plain match are left out.

    Limits are running sums over a row's matches, overlaps a sweep over them in order, so a text with very many matches takes no more for each.
    """
    spans = found.select("row", F.explode("found").alias("x")).select("row", "x.*").repartition("row")
    own = Window.partitionBy("row", "rank").orderBy("i")
    spans = spans.withColumn("to", F.sum(F.col("gap") + F.col("size")).over(own).cast("int")).withColumn("from", F.col("to") - F.col("size")).filter(_valid(F.col("rank"), F.col("value")))
    order = Window.partitionBy("row")
    plain = F.col("rank") < len(KINDS)
    reach = F.max(F.when(plain, F.col("to"))).over(order.orderBy("from", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.min(F.when(plain, F.col("from"))).over(order.orderBy(F.desc("from"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = spans.withColumns({"reach": reach, "next": ahead}).filter("rank < 4 or (coalesce(reach, 0) <= `from` and coalesce(next, `to`) >= `to`)")
    return spans.select("row", "rank", "from", "to", F.sha2("value", 256).alias("value"), "one", "three", "after")


def _patterns(tokens: DataFrame) -> DataFrame:
    """One row for each token and lexical pattern around it."""
    one, three, after = F.col("one"), F.col("three"), F.col("after")
    made = F.array(
        F.when(one.rlike("[:=#]$"), F.concat(F.lit("label "), one)),
        F.when(three != "", F.concat(F.lit("ahead "), three)),
        F.when((one != "") & (after != ""), F.concat(F.lit("around "), one, F.lit(" _ "), after)),
    )
    return tokens.withColumn("pattern", F.explode(F.array_compact(made))).drop("one", "three", "after")


def _learn(tokens: DataFrame, rounds: int) -> DataFrame:
    """Values that confident patterns agree on. ``tokens`` has value, seed and pattern."""
    edges = settle(tokens.groupBy("pattern", "value").agg(F.max("seed").alias("seed")))
    score = settle(edges.groupBy("value").agg(F.max("seed").cast("double").alias("score")))
    for _ in range(rounds):
        rated = edges.join(score, "value").groupBy("pattern").agg(F.sum("score").alias("known"), F.count("*").alias("all"))
        rated = rated.filter(f"known >= {LEAST_KNOWN}").withColumn("trust", F.col("known") / (F.col("all") + 1)).filter(f"trust >= {LEAST_PATTERN}")
        doubt = F.exp(F.sum(F.log(1 - F.col("trust") * 0.999)))
        new = edges.join(rated, "pattern", "left").groupBy("value").agg(F.max("seed").alias("seed"), F.coalesce(1 - doubt, F.lit(0.0)).alias("held"))
        new = settle(new.select("value", F.when(F.col("seed"), 1.0).when(F.col("held") >= LEAST_TOKEN, F.col("held")).otherwise(0.0).alias("score"), "seed"))
        drop(score)
        score = new
    return score.filter("score > 0 and not seed").select("value")


def find(docs: DataFrame, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find personal data in every text.

    Returns one row per input row: ``doc_id``; ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (plain spans); ``base_sha256`` of the plain
    spans; ``spans``, those and the discovered ones (kind ``context``) as kind:start:end in code points, by start, then kind;
    ``n_context``. A discovered span never overlaps a plain one.

    A null text is empty. Null ids stay null; rows with one id are searched each for itself. A token's score depends on its value and on distinct values
    around a pattern, so repeated rows change nothing. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    found = settle(_matches(rows))
    spans = settle(_spans(found))
    tokens = settle(_patterns(spans.withColumn("seed", F.col("rank") < len(KINDS))))
    known = _learn(tokens, rounds)
    extra = tokens.filter("not seed").select("row", "rank", "from", "to", "value").distinct().join(known, "value").select("row", "rank", "from", "to")
    plain = spans.filter(F.col("rank") < len(KINDS)).select("row", "rank", "from", "to")
    kind = F.element_at(F.array(*map(F.lit, (*KINDS, "context"))), F.col("rank") + 1)
    said = F.struct("from", "rank", "to", F.concat_ws(":", kind, "from", "to").alias("said"))
    each = plain.union(extra).groupBy("row").agg(F.array_sort(F.collect_list(said)).alias("all"))
    join = lambda spans: F.array_join(F.transform(spans, lambda x: x["said"]), ",")
    count = lambda rank: F.coalesce(F.size(F.filter("all", lambda x: x["rank"] == rank)), F.lit(0)).cast("long")
    out = found.select("row", "doc_id").join(each, "row", "left")
    base = F.coalesce(join(F.filter("all", lambda x: x["rank"] < len(KINDS))), F.lit(""))
    return out.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)), F.sha2(base, 256).alias("base_sha256"), F.coalesce(join(F.col("all")), F.lit("")).alias("spans"), count(len(KINDS)).alias("n_context"))
