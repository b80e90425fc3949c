"""Personal data: base patterns, and spans added by weak supervision, in DataFrame operations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_of, written

#: In the order of results; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "id", "name", "secret")

# Possessive quantifiers and the start conditions keep each search linear: a match starts where no earlier start could have
# matched, after a character that can't belong to it or where the match before ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Common given names; more come as a parameter.
GIVEN_NAMES = (
    "James Mary John Anna Peter Maria Paul Julia Michael Sarah Thomas Laura Jean Marie Jose Carmen Hans Ursula David Emma Robert Patricia William Jennifer Richard Linda Joseph Elizabeth Charles Barbara "
    "Daniel Susan Matthew Jessica Anthony Karen Mark Lisa Steven Nancy Andrew Betty Kenneth Sandra George Margaret Joshua Ashley Kevin Emily Brian Donna Edward Michelle Klaus Sabine Wolfgang Petra Stefan "
    "Monika Andreas Claudia Martin Birgit Christian Heike Pierre Nathalie Philippe Isabelle Alain Sylvie Nicolas Catherine Francois Camille Antonio Lucia Manuel Elena Francisco Pilar Javier Rosa Miguel Ana "
    "Giovanni Giulia Marco Francesca Luca Chiara Mohammed Fatima Ahmed Aisha Ali Wei Ming Yuki Hiroshi Raj Priya Ivan Olga Sergei Natasha"
).split()
#: How keys of well-known issuers begin, and words that a secret is assigned to.
KEY_FORMS = r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{10,}+"
SECRET_WORDS = r"password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"
ASSIGNED = rf"(?i:{SECRET_WORDS})\x20?[=:]\x20?[\"']?"
#: Forms of address before a name, and after them what is no name.
TITLES, GREETED = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?)\.?\x20", r"(?:Dear|Signed|signed|[Nn]ame(?:\x20is|:)|Sincerely,|Contact)\x20"
NO_NAMES = r"^(?:Sir|Sirs|Madam|Madame|All|Team|Friend|Friends|Customer|Colleagues?|Reader|The|This|That|Us|Support|Sales)\b"
_CAPITAL = r"[A-Z\u00c0-\u00de][a-z\u00df-\u00ff]{1,30}"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"


def loose(names: list[str]) -> str:
    """What the labelers vote on, outside base spans: shapes of numbers, key-like runs, known keys, whatever is assigned to a word for
    secrets, and names by title, greeting or given name."""
    return (
        r"(?<![0-9A-Za-z_+-])(?:"
        r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"
        r"|[0-9]{3}-[0-9]{2}-[0-9]{4}"
        r"|[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}"
        rf"|{KEY_FORMS}"
        r"|[A-Za-z0-9_-]{32,}+"
        rf"|(?<=[=:]\x20?[\"']?)(?<={ASSIGNED})[A-Za-z0-9_!@#$%^&*+/=~-]{{6,}}+"
        rf"|(?=[A-Z\u00c0-\u00de])(?:{TITLES}{_CAPITAL}(?:\x20{_CAPITAL})?|(?<={GREETED}){_CAPITAL}(?:\x20{_CAPITAL})?|(?:{'|'.join(names)})\x20{_CAPITAL})"
        r")(?![0-9A-Za-z])"
    )


FOR = {
    "card": r"(?i)(card|visa|master|credit|carte|karte|tarjeta|payment)[^0-9]{0,20}$",
    "phone": r"(?i)(phone|tel|call|mobile|fax|cell|handy|contact)[^0-9]{0,20}$",
    "id": r"(?i)(ssn|social|passport|identity|national|ausweis|dni)[^0-9]{0,20}$",
    "name": rf"(?:{GREETED}|(?i:by|from|to|with)\x20)$",
    "secret": r"(?i)(token|secret|password|passwd|passphrase|pwd|api.?key|key|bearer)[\x20\"'=:]{0,6}$",
}
AGAINST = r"(?i)(order|invoice|isbn|version|page|item|build|commit|sha|md5|ref|no)[\x20#:.=]{0,4}$"
#: Labelers, and candidates of each kind that their reliabilities are taken to have been seen on beforehand.
LABELERS, CERTAIN = 4, 10.0
MARK, PLAIN = "\x01", "\x02"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    d = _digits(m)
    if kind == "card":
        return F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False))
    return F.length(d).between(8, 15)


def _found(text: Column, pattern: str, kind: Column | str, worth: Column) -> Column:
    """Array of (kind, gap, found, before): each match with the length and the last 40 characters of the text between it and
    the one before. One search marks the matches; the cut at the marks gives matches and gaps in turn."""
    parts = F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1)

    def one(p: Column) -> Column:
        return F.transform(
            F.filter(F.sequence(F.lit(1), F.greatest(F.size(p) - 1, F.lit(1))), lambda i: (i % 2 == 1) & (i < F.size(p))),
            lambda i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(F.element_at(p, i)).cast("long").alias("gap"), F.element_at(p, i + 1).alias("found"), F.right(F.element_at(p, i), F.lit(40)).alias("before")),
        )

    nothing = F.array().cast("array<struct<kind:string,i:int,gap:bigint,found:string,before:string>>")
    return F.when(worth, F.element_at(F.transform(F.array(parts), one), 1)).otherwise(nothing)


def candidate_spans(docs: DataFrame, id_col: str, text_col: str, names: list[str] = GIVEN_NAMES) -> DataFrame:
    """(uid, id, kind, start, end, base, found, before), a row with null kind for each document without any.

    uid numbers the rows of docs. Base spans are valid; the others, of loose shapes, overlap none of them.
    """
    text = F.translate(text_of(text_col), MARK, PLAIN)
    t = F.col("_t")
    digits = t.rlike("[0-9]")
    arrays = F.concat(
        _found(t, EMAIL, "email", F.contains(t, F.lit("@"))),
        _found(t, IP, "ip", digits),
        _found(t, CARD, "card", digits),
        _found(t, PHONE, "phone", F.contains(t, F.lit("+"))),
        _found(t, loose(names), "loose", F.lit(True)),
    )
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_t")).withColumn("_uid", F.monotonically_increasing_id())
    every = rows.select("_uid", "_id", F.explode_outer(arrays).alias("s")).select("_uid", "_id", "s.*").repartition("_uid")
    order = W.partitionBy("_uid", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    placed = every.withColumn("end", F.sum(F.col("gap") + F.length("found")).over(order)).withColumn("start", F.col("end") - F.length("found"))
    base = F.lit(False)
    for kind in KINDS[:4]:
        base = base | ((F.col("kind") == kind) & _valid(kind, F.col("found")))
    placed = placed.withColumn("base", F.coalesce(base, F.lit(False)))
    by_start = W.partitionBy("_uid").orderBy("start", F.desc("base"))
    ended = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rowsBetween(W.unboundedPreceding, -1))
    begins = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rowsBetween(1, W.unboundedFollowing))
    clear = placed.withColumn("_ended", ended).withColumn("_begins", begins).withColumn("_first", F.row_number().over(by_start))
    free = (F.col("kind") == "loose") & (F.coalesce("_ended", F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("_begins") >= F.col("end"), F.lit(True)))
    spans = clear.withColumn("_span", F.col("base") | F.coalesce(free, F.lit(False)))
    shape = (
        F.when(F.col("found").rlike(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"), "phone")
        .when(F.col("found").rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "id")
        .when(F.col("found").rlike(r"^[0-9\x20-]+$"), "card")
        .when(F.col("before").rlike(f"{ASSIGNED}$"), "secret")
        .when(F.col("found").rlike(rf"^(?:{TITLES})?{_CAPITAL}(?:\x20{_CAPITAL})?$"), "name")
        .otherwise("secret")
    )
    kind = F.when(F.col("_span"), F.when(F.col("base"), F.col("kind")).otherwise(shape))
    # Of the rows that are no spans, each document's first stays, so that every document has a row.
    return spans.where(F.col("_span") | (F.col("_first") == 1)).select("_uid", "_id", kind.alias("kind"), "start", "end", "base", "found", "before")


def votes(kind: Column, found: Column, before: Column, names: list[str] = GIVEN_NAMES) -> list[Column]:
    """What the labelers say of a candidate: 1 personal, 0 not, null nothing."""
    d = _digits(found)
    shape = (
        F.when(kind == "card", F.when(F.length(d).between(13, 19), _luhn(d).cast("int")).otherwise(0))
        .when(kind == "phone", F.when(d.rlike("^[2-9]"), 1).otherwise(0))
        .when(kind == "id", F.when(d.rlike("^(000|666|9)"), 0).otherwise(1))
        .when(kind == "secret", F.when(found.rlike("[0-9]") & found.rlike("[A-Za-z]") & ~found.rlike("[_-]{2}|^[A-Za-z_-]+$"), 1).otherwise(0))
        .when((kind == "name") & found.rlike(f"^{TITLES}"), 1)
    )
    gazetteer = (
        F.when(kind == "card", F.when(d.rlike(ISSUERS), 1).otherwise(0))
        .when((kind == "name") & found.rlike(rf"(?:^|\x20)(?:{'|'.join(names)})(?:\x20|$)"), 1)
        .when((kind == "secret") & found.rlike(rf"^(?:[0-9a-f]{{32}}|[0-9a-f]{{40}}|[0-9a-f]{{64}}|{KEY_FORMS})$"), 1)
    )
    context = F.lit(None).cast("int")
    for k, pattern in FOR.items():
        context = F.when((kind == k) & before.rlike(pattern), 1).otherwise(context)
    against = F.when(before.rlike(AGAINST) | ((kind == "name") & found.rlike(NO_NAMES)), 0)
    return [shape.cast("int"), gazetteer.cast("int"), context.cast("int"), against.cast("int")]


def traits(found: Column, before: Column) -> list[Column]:
    """What the span classifier sees of a span and of what stands before it, each true or false."""
    many = F.size(F.array_distinct(F.split(found, ""))) >= 10
    return [
        found.rlike("[0-9]"), found.rlike("[a-z]"), found.rlike("[A-Z]"), found.rlike("[^0-9A-Za-z]"), F.length(found) >= 16, F.length(found) >= 32, many,
        before.rlike("[=:\"']\\x20?$"), before.rlike(r"[A-Za-z]{2,}\x20$"), before.rlike(r"(?:^|[.!?\x0A])\x20*$"),
    ]


class LabelModel:
    """Labelers' reliabilities by expectation-maximisation over counted vote patterns, and a logistic span classifier
    trained on the posteriors, which sees the votes, the kind, and for each kind the traits of the span and its context.

    patterns: rows (kind, votes of the labelers, traits as bits, count), at most 3^4 * 2^10 for each kind.
    """

    def __init__(self, patterns: list[tuple[str, tuple[int | None, ...], int, int]], n_traits: int = 0, rounds: int = 50):
        self.kinds, self.n_traits = sorted({p[0] for p in patterns}), n_traits
        kind = np.array([self.kinds.index(p[0]) for p in patterns], np.int64)
        said = np.array([[-1 if v is None else v for v in p[1]] for p in patterns], np.int64).reshape(len(patterns), LABELERS)
        count = np.array([p[3] for p in patterns], float)
        kinds = len(self.kinds)
        prior = np.full(kinds, 0.3)
        # P(no, yes, silence) of each class, labeler and kind: to start with, and as what CERTAIN counts would have shown. Labelers that
        # only ever say one thing, or nothing on some kind, are judged by when they do.
        start = np.array([[0.45, 0.1, 0.45], [0.05, 0.5, 0.45]])[:, None, None, :]
        chance = np.broadcast_to(start, (2, LABELERS, kinds, 3)).copy()
        yes, no = said == 1, said == 0
        say = np.where(said < 0, 2, said)
        each = np.arange(LABELERS)[None, :]
        post = np.zeros(len(patterns))
        for _ in range(rounds if patterns else 0):
            odds = np.log(prior / (1 - prior))[kind] + np.log(chance[1, each, kind[:, None], say] / chance[0, each, kind[:, None], say]).sum(axis=1)
            post = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
            prior = (0.3 * 2 + np.bincount(kind, count * post, kinds)) / (2 + np.bincount(kind, count, kinds))
            for c, of in ((0, 1 - post), (1, post)):
                seen = np.zeros((LABELERS, kinds, 3))
                np.add.at(seen, (each, kind[:, None], say), (count * of)[:, None])
                chance[c] = (seen + CERTAIN * start[c]) / (seen.sum(axis=2, keepdims=True) + CERTAIN)
            # No labeler speaks rather for the wrong class, or the classes may change places.
            for v, wrong in ((1, chance[1, ..., 1] < chance[0, ..., 1]), (0, chance[1, ..., 0] > chance[0, ..., 0])):
                chance[..., v] = np.where(wrong, chance[..., v].mean(axis=0), chance[..., v])
        self.prior = dict(zip(self.kinds, prior.tolist(), strict=True))
        cast = np.maximum(1e-9, np.stack([(count * post) @ (yes | no), (count * (1 - post)) @ (yes | no)]))
        #: Of each labeler, how often what it says is right: of personal and of other candidates.
        self.right = np.stack([(count * post) @ yes / cast[0], (count * (1 - post)) @ no / cast[1]], axis=1).tolist()
        # Columns: the kind, for each labeler whether it says no and whether it says yes, and the traits by kind.
        bits = np.array([p[2] for p in patterns], np.int64)
        has = (bits[:, None] >> np.arange(n_traits) & 1).astype(float)
        by_kind = (kind[:, None] == np.arange(len(self.kinds))).astype(float)
        x = np.concatenate([by_kind, np.stack([no, yes], axis=2).reshape(len(patterns), 2 * LABELERS), (by_kind[:, :, None] * has[:, None, :]).reshape(len(patterns), len(self.kinds) * n_traits)], axis=1)
        w, whole = np.zeros(x.shape[1]), max(1.0, count.sum())
        for _ in range(400 if patterns else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w += 2.0 * (x.T @ (count / whole * (post - p)) - 1e-4 * w)
        names = [("kind", k) for k in self.kinds] + [(i, v) for i in range(LABELERS) for v in (0, 1)] + [("trait", k, n) for k in self.kinds for n in range(n_traits)]
        self.weights = dict(zip(names, w.tolist(), strict=True))

    def score(self, kind: Column, said: list[Column], bits: Column) -> Column:
        total = F.lit(0.0)
        for name, w in self.weights.items():
            if name[0] == "kind":
                on = kind == name[1]
            elif name[0] == "trait":
                on = (kind == name[1]) & (F.getbit(bits, F.lit(name[2])) == 1)
            else:
                on = F.coalesce(said[name[0]] == name[1], F.lit(False))
            total = total + F.when(on, F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5, names: list[str] = GIVEN_NAMES) -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are of the base spans; spans holds them and those that the classifier adds, as
    kind:start:end in code points, by kind and start. Null and empty texts have none. Whole texts are searched; repeated
    rows each return. Added spans overlap no base span. names: the gazetteer of given names. Besides the spans found, only the
    counts of patterns of votes and traits reach the driver, whose number has a bound that no input moves.
    """
    said, seen = votes(F.col("kind"), F.col("found"), F.col("before"), names), traits(F.col("found"), F.col("before"))
    cols = [f"v{i}" for i in range(LABELERS)]
    bits = sum((F.coalesce(t, F.lit(False)).cast("int") * F.lit(1 << n) for n, t in enumerate(seen)), F.lit(0))
    found = candidate_spans(docs, id_col, text_col, names)
    more = [F.when(~F.col("base"), v).alias(c) for c, v in zip([*cols, "bits"], [*said, bits], strict=True)]
    spans = written(found.select("_uid", "_id", "kind", "start", "end", "base", *more), "pii-spans")
    counted = spans.where("not base and kind is not null").groupBy("kind", *cols, "bits").count().collect()
    model = LabelModel(sorted(((r["kind"], tuple(r[c] for c in cols), r["bits"], r["count"]) for r in counted), key=repr), len(seen))
    added = model.score(F.col("kind"), [F.col(c) for c in cols], F.col("bits")) >= least
    kept = F.col("kind").isNotNull() & (F.col("base") | added)
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    item = F.struct(number.alias("n"), "start", "end", "base", F.concat_ws(":", "kind", "start", "end").alias("s"))
    rows = spans.groupBy("_uid", "_id").agg(F.sort_array(F.collect_list(F.when(kept, item))).alias("all"))
    joined = lambda keep: F.array_join(F.transform(F.filter("all", keep), lambda x: x["s"]), ",")
    count = lambda n: F.size(F.filter("all", lambda x: x["base"] & (x["n"] == n))).cast("long")
    return rows.select(
        F.col("_id").alias(id_col),
        *[count(n + 1).alias(f"n_{k}") for n, k in enumerate(KINDS[:4])],
        F.sha2(joined(lambda x: x["base"]), 256).alias("base_sha256"),
        joined(lambda x: F.lit(True)).alias("spans"),
    )
