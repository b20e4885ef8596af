"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Entities are found by one regular expression.  Every entity is made of units (a name's
words, or the whole of any other entity) in canonical form: an e-mail in lower case, a phone or card as
its digits.  Each distinct unit gets one surrogate of its type from a keyed digest, so equal
entities in different formats get the same surrogate everywhere (coreference).  The table of
units is then checked: where two units share a surrogate, or a surrogate is a real unit of the
corpus, all but one draw again, until none collides (distinctness).  An e-mail is two units, its domain and its mailbox
there.  From the third draw on, names, mailboxes, domains, passwords and short phone numbers get longer with every draw, so few rounds suffice however many units
there are.  Surrogates keep the format: punctuation, letter case, digit places, a card's first digit and check digit, an
address's octets, a title and with it the gender, and the script of a name.

Texts are matched by digest, so copies are handled once; only texts with entities are rebuilt, from
the pieces between the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare, unused

# fixed values: titles by gender, and name parts by gender and script
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"],
    "n": ["Dr", "Prof", "Mx"],
}
ENDINGS = {
    ("m", "latin"): ["us", "an", "or", "en", "er"], ("f", "latin"): ["a", "ia", "ine", "elle", "ette"], ("n", "latin"): ["y", "is", "ey", "e", "in"],
    ("m", "cyrillic"): ["ан", "ор", "ей", "ил", "ур"], ("f", "cyrillic"): ["а", "ия", "ина", "ела", "ета"], ("n", "cyrillic"): ["и", "о", "е", "ис", "ю"],
}
SYLLABLES = {
    "latin": ["ba", "del", "fi", "gor", "han", "jo", "ka", "lem", "mar", "no", "per", "ri", "sol", "ta", "vel", "zu"],
    "cyrillic": ["ба", "дел", "фи", "гор", "хан", "ко", "ка", "лем", "мар", "но", "пер", "ри", "сол", "та", "вел", "зу"],
}

_ALL_TITLES = "|".join(t for ts in TITLES.values() for t in ts)
_NAME = r"\p{Lu}[\p{L}'-]{1,30}+"
KINDS = {
    "secret": r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|(?i:password|passwd|pwd)=[^\s\"']++|[0-9a-f]{32,64}+(?![0-9A-Za-z])",
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![0-9]|\.[0-9])",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![0-9-])",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![0-9A-Za-z])|\(\d{3}\) ?\d{3}[-.]\d{4}(?!\d)|\d{3}[-.]\d{3}[-.]\d{4}(?!\d)",
    "card": r"\d(?:[ -]?\d){12,18}(?![0-9A-Za-z])",
    "name": rf"(?:{_ALL_TITLES})\.? {_NAME}(?: {_NAME}){{0,2}}",
}
PATTERN = r"(?<![A-Za-z0-9._%+\p{L}-])(?:" + "|".join(KINDS.values()) + ")"


def _kind(raw: Column) -> Column:
    out = None
    for name, pattern in KINDS.items():
        whole = raw.rlike(f"^(?:{pattern})$")
        out = F.when(whole, name) if out is None else out.when(whole, name)
    return out


def _draw(seed: Column, place: Column | int, most: int) -> Column:
    """A keyed number from 0 to ``most`` - 1 for a place of a unit."""
    text = F.concat_ws("|", seed, F.lit(place).cast("string") if isinstance(place, int) else place.cast("string"))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long"), F.lit(most))


def _pick(options: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (number + 1).cast("int"))


def _letters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _masked(text: Column, seed: Column) -> Column:
    """Every letter and digit replaced within its class, all else kept."""
    def one(c, i):
        return (F.when(c.rlike("[0-9]"), _draw(seed, i, 10).cast("string"))
                .when(c.rlike("[a-f]"), _pick(list("abcdef"), _draw(seed, i, 6)))
                .when(c.rlike("[g-z]"), _pick(list("ghijklmnopqrstuvwxyz"), _draw(seed, i, 20)))
                .when(c.rlike("[A-Z]"), _pick(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _draw(seed, i, 26))).otherwise(c))
    return F.array_join(F.transform(_letters(text), one), "")


def _hidden(text: Column, seed: Column) -> Column:
    """Every character replaced: letters and digits as in ``_masked``, those of other scripts and signs too."""
    def one(c, i):
        return (F.when(c.rlike(r"[0-9A-Za-z\s]"), c).when(c.rlike(r"\p{IsCyrillic}"), _pick(list("абвгдежзиклмнопрстуфхцчшэюя"), _draw(seed, i, 27)))
                .when(c.rlike(r"[\p{L}\p{M}\p{N}]"), _pick(list("abcdefghijklmnopqrstuvwxyz"), _draw(seed, i, 26)))
                .otherwise(_pick(list("#$%&*+-/=@^_~"), _draw(seed, i, 13))))
    return F.array_join(F.transform(_letters(_masked(text, seed)), one), "")


def _more(seed: Column, options: list[str]) -> Column:
    """Nothing for the first two draws of a unit, then one option more with every draw."""
    n = F.col("attempt") - 1
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: _pick(options, _draw(seed, i + 1000, len(options)))), "")).otherwise("")


def _luhn(digits: Column) -> Column:
    """Check sum of a digit string, 0 if valid."""
    total = F.aggregate(F.transform(F.reverse(_letters(digits)), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))), F.lit(0), lambda a, b: a + b)
    return total % 10


def _card(canon: Column, seed: Column) -> Column:
    head = F.concat(F.substring(canon, 1, 1), _masked(F.expr("substring(canon, 2, length(canon) - 2)"), seed))
    check = F.pmod(10 - _luhn(F.concat(head, F.lit("0"))), F.lit(10)).cast("string")
    return F.concat(head, F.when(_luhn(canon) == 0, check).otherwise(_draw(seed, 99, 10).cast("string")))


def _phone(canon: Column, seed: Column) -> Column:
    """National number redrawn; the country code, and an area or exchange digit above 1, stay so.

    From the third draw on an exchange 555 is redrawn too, and a number of under 10 digits gets longer.
    """
    def one(c, i):
        back = F.length(canon) - i  # 10: first digit of the area, 7: first of the exchange
        keep = (back > 10) | ((F.length(canon) >= 10) & (back <= 7) & (back >= 5) & (F.substring(canon, -7, 3) == "555") & (F.col("attempt") < 2))
        return F.when(keep, c).when(back.isin(10, 7), (_draw(seed, i, 8) + 2).cast("string")).otherwise(_draw(seed, i, 10).cast("string"))
    more = F.when(F.length(canon) < 10, _more(seed, list("0123456789"))).otherwise("")
    return F.concat(F.array_join(F.transform(_letters(canon), one), ""), more)


def _ip(canon: Column, seed: Column) -> Column:
    return F.concat_ws(".", (_draw(seed, 1, 223) + 1).cast("string"), *[_draw(seed, i, 256).cast("string") for i in (2, 3, 4)])


def _secret(canon: Column, seed: Column) -> Column:
    cut = F.when(canon.startswith("AKIA"), 4).when(canon.contains("="), F.instr(canon, "=")).otherwise(0)
    rest = F.substring(canon, cut + 1, F.length(canon))
    # the sentence's marks after a password stay, if there is a password before them
    body = F.regexp_extract(rest, r"^(.*?[^.,;:!?)\]}])[.,;:!?)\]}]*$", 1)
    body = F.when(body == "", rest).otherwise(body)
    tail = F.substring(rest, F.length(body) + 1, F.length(rest))
    more = F.when(canon.contains("="), _more(seed, list("abcdefghijklmnopqrstuvwxyz0123456789"))).otherwise("")
    return F.concat(F.substring(canon, F.lit(1), cut), _hidden(body, seed), more, tail)


def _mailbox(canon: Column, seed: Column) -> Column:
    """A new mailbox at the real domain, so that addresses of one domain are kept apart; the domain is a unit of its own."""
    more = _more(seed, list("abcdefghijklmnopqrstuvwxyz0123456789"))
    return F.concat(_masked(F.substring_index(canon, "@", 1), seed), more, F.lit("@"), F.substring_index(canon, "@", -1))


def _domain(canon: Column, seed: Column) -> Column:
    """Every label but the last redrawn; from the third draw on the one before it gets longer."""
    last = F.substring_index(canon, ".", -1)
    body = F.substring(canon, F.lit(1), F.length(canon) - F.length(last) - 1)
    return F.concat(_masked(body, seed), _more(seed, list("abcdefghijklmnopqrstuvwxyz0123456789")), F.lit("."), last)


def _word(canon: Column, seed: Column, gender: str | None) -> Column:
    out = None
    for script, parts in SYLLABLES.items():
        body = F.concat(*[_pick(parts, _draw(seed, i, len(parts))) for i in range(4 if gender is None else 3)], _more(seed, parts))
        name = F.initcap(body if gender is None else F.concat(body, _pick(ENDINGS[gender, script], _draw(seed, 9, 5))))
        out = F.when(canon.rlike(r"\p{IsCyrillic}") if script == "cyrillic" else F.lit(True), name) if out is None else F.when(
            canon.rlike(r"\p{IsCyrillic}"), name).otherwise(out)
    return out


def _surrogate(units: DataFrame) -> DataFrame:
    """``surrogate`` of rows (key, unit, canon, attempt)."""
    seed = F.concat_ws("|", "key", "unit", "canon", F.col("attempt").cast("string"))
    canon = F.col("canon")
    digits = _masked(canon, seed)
    made = {"mailbox": _mailbox(canon, seed), "domain": _domain(canon, seed), "ip": _ip(canon, seed), "phone": _phone(canon, seed), "card": _card(canon, seed),
            "secret": _secret(canon, seed), "family": _word(canon, seed, None),
            "given_m": _word(canon, seed, "m"), "given_f": _word(canon, seed, "f"), "given_n": _word(canon, seed, "n")}
    out = None
    for unit, column in made.items():
        out = F.when(F.col("unit") == unit, column) if out is None else out.when(F.col("unit") == unit, column)
    # an IBAN keeps its country
    return units.withColumn("surrogate", out.when(F.col("unit") == "iban", F.concat(F.substring(canon, 1, 2), _masked(F.expr("substring(canon, 3)"), seed)))
                            .otherwise(digits))


def surrogate_table(units: DataFrame, key: str) -> DataFrame:
    """(unit, canon, surrogate) for the distinct (unit, canon): one to one, and none a canon of the corpus.

    Units whose draw is free are settled; only the others draw again, against the settled ones too.
    """
    base = units.distinct().select(F.lit(key).alias("key"), "unit", "canon", F.lit(0).alias("attempt"))
    base = all_units = materialize(base, "unit_draws")
    settled = None
    while True:
        now = materialize(_surrogate(base), "surrogates")
        first = materialize(now.groupBy("unit", "surrogate").agg(F.min("canon").alias("holder")), "holders")
        taken = all_units.select("unit", F.col("canon").alias("surrogate"))
        if settled is not None:
            taken = taken.unionAll(settled.select("unit", "surrogate"))
        taken = taken.join(first.select("unit", "surrogate"), ["unit", "surrogate"], "left_semi").distinct().withColumn("taken", F.lit(True))
        checked = now.join(first, ["unit", "surrogate"]).join(taken, ["unit", "surrogate"], "left")
        again = F.col("taken").isNotNull() | (F.col("canon") != F.col("holder"))
        checked = materialize(checked.select("key", "unit", "canon", "surrogate", "attempt", again.alias("again")), "checked")
        good = checked.where("NOT again").select("unit", "canon", "surrogate")
        settled = good if settled is None else settled.unionAll(good)
        base = checked.where("again").select("key", "unit", "canon", (F.col("attempt") + 1).alias("attempt"))
        if base.isEmpty():
            return settled


def _units(mentions: DataFrame) -> DataFrame:
    """(raw, kind, prefix, place, unit, canon, piece): the units of every distinct mention."""
    title = F.regexp_extract("raw", rf"^((?:{_ALL_TITLES})\.? )", 1)
    gender = F.lit("n")
    for g in ("m", "f"):
        gender = F.when(F.regexp_replace(title, r"[. ]", "").isin(TITLES[g]), g).otherwise(gender)
    named = mentions.where("kind = 'name'").select("raw", "kind", title.alias("prefix"), gender.alias("gender"))
    words = F.split(F.expr("substring(raw, length(prefix) + 1)"), " ")
    named = named.select("raw", "kind", "prefix", "gender", F.size(words).alias("n"), F.posexplode(words).alias("place", "piece"))
    named = named.select("raw", "kind", "prefix", "place", F.when(F.col("place") == F.col("n") - 1, "family").otherwise(
        F.concat(F.lit("given_"), F.col("gender"))).alias("unit"), F.initcap("piece").alias("canon"), "piece")
    raw, digits = F.col("raw"), F.regexp_replace("raw", "[^0-9]", "")
    canon = (F.when(F.col("kind") == "phone", F.when(F.length(digits).eqNullSafe(F.lit(11)) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits))
             .when(F.col("kind").isin("card", "ssn"), digits)
             .when(F.col("kind") == "iban", F.regexp_replace(raw, " ", "")).otherwise(raw))
    mail = mentions.where("kind = 'email'").select("raw", "kind", F.lit("").alias("prefix"), F.posexplode(F.array(
        F.struct(F.lit("mailbox").alias("unit"), F.lower(raw).alias("canon"), F.substring_index(raw, "@", 1).alias("piece")),
        F.struct(F.lit("domain").alias("unit"), F.lower(F.substring_index(raw, "@", -1)).alias("canon"), F.substring_index(raw, "@", -1).alias("piece")))
    ).alias("place", "of")).select("raw", "kind", "prefix", "place", "of.unit", "of.canon", "of.piece")
    plain = mentions.where("kind NOT IN ('name', 'email')").select("raw", "kind", F.lit("").alias("prefix"), F.lit(0).alias("place"),
                                                    F.col("kind").alias("unit"), canon.alias("canon"), raw.alias("piece"))
    return named.unionAll(mail).unionAll(plain)


def _formatted(piece: Column, surrogate: Column, unit: Column) -> Column:
    """A unit's surrogate in the format of one mention of it: places from the right, letter case.

    What a longer surrogate has beyond the mention's places comes before the first of them.
    """
    surrogate = F.when(unit == "mailbox", F.substring_index(surrogate, "@", 1)).otherwise(surrogate)
    places = F.length(F.regexp_replace(piece, "[^0-9A-Za-z]", ""))
    surplus = F.when(F.length(surrogate) > places, F.substring(surrogate, F.lit(1), F.length(surrogate) - places)).otherwise("")
    filled = F.array_join(F.reverse(F.aggregate(
        F.reverse(_letters(piece)), F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("used")),
        lambda a, c: F.when(c.rlike("[0-9A-Za-z]") & (a["used"] < F.length(surrogate)),
                            F.struct(F.concat(a["out"], F.array(F.substring(surrogate, F.length(surrogate) - a["used"], F.lit(1)))).alias("out"),
                                     (a["used"] + 1).alias("used")))
        .otherwise(F.struct(F.concat(a["out"], F.array(c)).alias("out"), a["used"].alias("used"))))["out"]), "")
    upper = (piece == F.upper(piece)) & (piece != F.lower(piece))
    lead = F.regexp_extract(filled, "^[^0-9A-Za-z]*", 0)
    filled = F.concat(lead, surplus, F.substring(filled, F.length(lead) + 1, F.length(filled)))
    return (F.when(unit.isin("phone", "card", "ssn", "iban"), filled)
            .when(unit.isin("ip", "secret"), surrogate)
            .when(upper, F.upper(surrogate)).otherwise(surrogate))


def _renamed(gap: Column, known: Column) -> Column:
    """The words of ``gap`` that are a known name with a capital in front, replaced in their letter case; ``'s`` stays."""
    def one(word: Column) -> Column:
        stem = F.regexp_replace(word, "'s$", "")
        hit = F.get(F.filter(known, lambda k: k["piece"] == F.lower(stem)), 0)["s"]
        upper = (stem == F.upper(stem)) & (F.length(stem) > 1)
        made = F.concat(F.when(upper, F.upper(hit)).otherwise(hit), F.substring(word, F.length(stem) + 1, F.length(word)))
        return F.when(word.rlike(r"^\p{Lu}"), F.coalesce(made, word)).otherwise(word)
    words = F.split(gap, r"(?<=[\p{L}'-])(?![\p{L}'-])|(?<![\p{L}'-])(?=[\p{L}'-])")
    return F.array_join(F.transform(words, one), "")


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """All columns of ``docs`` (text, ...), the text with surrogates, plus n_entities and entity_kinds.

    Every row gives one row.  A null text stays null, one without entities stays as it is, both
    with n_entities 0.  Equal texts get equal results.  Names are found by a title; other mentions of such a name's words in the
    same text are replaced alike and not counted.  Columns named n_entities and
    entity_kinds are replaced; others pass through, null ids too.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("n_entities", "entity_kinds")
    digest, own, names = (unused(docs.columns, c) for c in ("digest", "made", "names"))
    found = F.regexp_extract_all(F.col("text").cast("string"), F.lit(PATTERN), F.lit(0))
    spans = (docs.select(F.md5("text").alias("digest"), found.alias("found")).where("size(found) > 0")
             .select("digest", F.posexplode("found").alias("at", "raw")).distinct())
    spans = materialize(spans, "spans")
    mentions = spans.select("raw").distinct().withColumn("kind", _kind(F.col("raw")))
    units = materialize(_units(mentions), "units")
    table = surrogate_table(units.select("unit", "canon"), key)
    made = (units.join(table, ["unit", "canon"])
            .groupBy("raw", "kind", "prefix")  # at most three units a mention
            .agg(F.array_sort(F.collect_list(F.struct("place", _formatted(F.col("piece"), F.col("surrogate"), F.col("unit")).alias("s"), "piece"))).alias("parts"))
            .select("raw", "kind", F.when(F.col("kind") == "email", F.array_join("parts.s", "@")).otherwise(
                F.concat("prefix", F.array_join("parts.s", " "))).alias("surrogate"),
                    F.when(F.col("kind") == "name", F.transform("parts", lambda p: F.struct(F.lower(p["piece"]).alias("piece"), F.initcap(p["s"]).alias("s")))).alias("words")))
    lists = (spans.join(materialize(made, "mentions"), "raw").groupBy("digest")
             .agg(F.array_sort(F.collect_list(F.struct("at", "surrogate", "kind"))).alias(own), F.flatten(F.collect_set("words")).alias(names)))
    # written, so that AQE can split the copies of one text; merged, as it grows with the texts
    lists = materialize(lists.withColumnRenamed("digest", digest), "lists")
    rows = docs.join(lists.hint("merge"), F.md5("text") == F.col(digest), "left")
    # a name learned from a mention with a title goes wherever its words stand in the same text
    known = F.array_sort(names)
    gaps = F.split("text", PATTERN, -1)
    gaps = F.when(F.size(names) > 0, F.transform(gaps, lambda gap: _renamed(gap, known))).otherwise(gaps)
    rebuilt = F.array_join(F.zip_with(gaps, f"{own}.surrogate", lambda gap, s: F.concat(gap, F.coalesce(s, F.lit("")))), "")
    return rows.select(*[F.when(F.col(own).isNull(), F.col("text")).otherwise(rebuilt).alias("text") if c == "text" else F.col(f"`{c}`")
                         for c in docs.columns],
                       F.coalesce(F.size(own), F.lit(0)).alias("n_entities"),
                       F.coalesce(F.array_sort(F.array_distinct(f"{own}.kind")), F.array().cast("array<string>")).alias("entity_kinds"))
