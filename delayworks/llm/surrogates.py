"""Surrogates for personal data, in DataFrame functions only.

Each character of a detected entity is moved within its class (digits, vowels or consonants of one
script and case) by a keyed hash of the characters before it, and then by one of those after it. So
the surrogate depends on all of the entity and the key, keeps its format, script and case, and both
passes can be undone: different entities get different surrogates, and one entity has the same one
everywhere, with nothing to look up. Names are replaced word by word and keep titles and last
letters, which carry the gender. A check over all units of the corpus, which are the words of names and the
other entities as a whole, makes sure that no surrogate is itself a unit of the corpus or another one's
surrogate: a unit for which it is takes tweaks of the key of its own until it isn't. As a word has one surrogate whatever
stands around it, "Mr Bi", "Dr Anna Bi" and "Bi" stay one name.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.llm.tables import free_name, stored

TWEAKS = 64
#: From this tweak on, surrogates get longer, but for IP addresses: few short ones may be free.
LONGER = 4

# The letters that move within their class, by script and case.
_LOWER = (
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "àáâãäåæèéêëìíîïòóôõöøùúûüœ",
    "çñßšžðþýÿł",
    "аеёиоуыэюя",
    "бвгджзйклмнпрстфхцчшщъь",
    "αεηιουωάέήίόύώ",
    "βγδζθκλμνξπρστφχψ",
)
CLASSES = ("0123456789", *_LOWER, *(text.replace("ß", "").upper() for text in _LOWER))
HEX = "0123456789abcdef"
_LETTER = r"A-Za-zÀ-ÖØ-öø-ÿŁłŒœŠšŽžΆ-ώЁА-яё"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = r"(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herrn?|Frau|Monsieur|Madame|Mme|Mlle|Señora?|Sra?|г-н|г-жа|κα|κ)\.?"
_CAPITAL = rf"[A-ZÀ-ÖØ-ÞŁŒŠŽΆ-ΫЁА-Я][{_LETTER}'’-]*[{_LETTER}]"

#: What is detected, the earlier kinds first where two begin at one place.
KINDS = {
    "email": rf"(?<![{_LETTER}0-9._%+-])[{_LETTER}0-9][{_LETTER}0-9._%+-]*+@[{_LETTER}0-9-]++(?:\.[{_LETTER}0-9-]++)*\.[A-Za-z]{{2,}}",
    "secret": r"\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9]{20,}\b"
    r"|\b(?:[Pp]assword|[Pp]asswd|[Ss]ecret|[Tt]oken|[Aa]pi[_-]?[Kk]ey)\s{0,3}[=:]\s{0,3}\"?[A-Za-z0-9+/_.-]{8,}\"?",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "account": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b|(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)",
    "name": rf"(?<![{_LETTER}]){_TITLE} {_CAPITAL}(?: {_CAPITAL}){{0,2}}",
}
#: All kinds begin at the beginning of a word or number, which spares most places of a text the tries.
ENTITY = rf"(?<![{_LETTER}0-9])(?=[{_LETTER}0-9+(])(?:{'|'.join(f'(?:{pattern})' for pattern in KINDS.values())})"
#: Every text with an entity has one of these; a plain search for them spares the others the rest.
HINT = rf"[@0-9]|AKIA|gh[pousr]_|sk-|[=:]\s{{0,3}}\"?[A-Za-z+/_.-]{{8}}|(?=[A-Zгκ]){_TITLE} "
_SECRET_HEAD = r"^(AKIA|gh._|sk-|[A-Za-z_-]+\s{0,3}[=:]\s{0,3}\"?)"


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is mentioned."""
    return F.transform(F.array(value), use)[0]


def _shift(salt: str, *context: Column) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), *context), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def _moved(character: Column, by: Column, classes: Column) -> Column:
    """The character moved within its class; characters of no class stay."""
    own = F.slice(F.filter(classes, lambda k: F.instr(k, character) > 0), 1, 1)
    moved = F.transform(
        own, lambda k: F.substring(k, (F.pmod(F.instr(k, character) - 1 + by, F.length(k)) + 1).cast("int"), F.lit(1))
    )
    return F.coalesce(F.get(moved, F.lit(0)), character)


def _passes(text: Column, salt: str, classes: Column) -> Column:
    """Every character moved by the hash of those before it, then by the hash of those after it."""
    forward = F.transform(
        F.split(text, ""), lambda c, i: _moved(c, _shift(salt, F.lit("<"), F.substring(text, F.lit(1), i)), classes)
    )

    def backward(t: Column) -> Column:
        after = lambda i: F.substring(t, i + 2, F.length(t))
        return F.transform(F.split(t, ""), lambda c, i: _moved(c, _shift(salt, F.lit(">"), after(i)), classes))

    return F.when(text == "", text).otherwise(F.array_join(_once(F.array_join(forward, ""), backward), ""))


def _luhn(head: Column) -> Column:
    """The check digit that the digits of the head ask for."""
    digits = F.reverse(F.filter(F.split(head, ""), lambda c: c.rlike(r"^\d$")))
    worth = F.transform(
        digits, lambda c, i: F.when(i % 2 == 0, F.floor(c.cast("int") * 2 / 10) + c.cast("int") * 2 % 10).otherwise(c.cast("int"))
    )
    return F.pmod(-F.aggregate(worth, F.lit(0).cast("long"), lambda a, v: a + v.cast("long")), F.lit(10))


def _ip(value: Column, salt: str) -> Column:
    """Four numbers from 0 to 255, moved as characters are."""
    moved = lambda o, context: F.pmod(o.cast("int") + _shift(salt, *context), F.lit(256)).cast("string")
    parts = F.split(value, r"\.")
    first = F.transform(parts, lambda o, i: moved(o, (F.lit("<"), F.array_join(F.slice(parts, 1, i), "."))))
    both = _once(
        first, lambda p: F.transform(p, lambda o, i: moved(o, (F.lit(">"), F.array_join(F.slice(p, i + 2, 4), "."))))
    )
    return F.array_join(both, ".")


def kind_of(value: Column) -> Column:
    kinds = iter(KINDS.items())
    kind, pattern = next(kinds)
    out = F.when(value.rlike(rf"^(?:{pattern})$"), kind)
    for kind, pattern in kinds:
        out = out.when(value.rlike(rf"^(?:{pattern})$"), kind)
    return out.otherwise("name")


def surrogate(value: Column, key: str, tweak: int = 0) -> Column:
    """The surrogate of an entity; no two entities of a kind have the same one.

    A domain's last label, what names a secret, a country code, titles and the last letters of names
    stay. The last digit of a card stays as right or wrong, by the Luhn sum, as it was.
    """
    salt = f"{key}:{tweak}"
    def cut(p: Column) -> Column:
        """(kind, what stays before, what moves, what stays after)"""
        found = lambda pattern: F.length(F.regexp_extract(p["value"], pattern, 0))
        head = (
            F.when(p["kind"] == "secret", found(_SECRET_HEAD))
            .when(p["kind"] == "phone", found(r"^\+\d{1,3}(?=[ .(-])"))
            .when(p["kind"] == "account", found(r"^[A-Z]{2}"))
            .when(p["kind"] == "name", found(rf"^{_TITLE} "))
            .otherwise(0)
        )
        tail = F.when(p["kind"] == "email", found(r"\.[^.]*$")).when(p["kind"] == "card", 1).otherwise(0)
        size = F.length(p["value"])
        return F.struct(
            p["kind"].alias("kind"),
            F.substring(p["value"], F.lit(1), head).alias("head"),
            F.substring(p["value"], head + 1, size - head - tail).alias("body"),
            F.substring(p["value"], size - tail + 1, tail).alias("tail"),
        )

    def made(p: Column) -> Column:
        name = p["kind"] == "name"
        hexadecimal = (p["kind"] == "secret") & p["body"].rlike('^[0-9a-f]+"?$')
        classes = F.when(hexadecimal, F.array(F.lit(HEX))).otherwise(F.array(*map(F.lit, CLASSES)))
        words = F.when(name, F.split(p["body"], " ")).otherwise(F.array(p["body"]))
        last = name.cast("int")
        moved = F.transform(
            words,
            lambda w: F.concat(
                _passes(F.substring(w, F.lit(1), F.length(w) - last), salt, classes),
                F.substring(w, F.length(w) - last + 1, last),
            ),
        )
        off = F.when(p["kind"] == "card", p["tail"].cast("int") - _luhn(p["body"]))
        tail = lambda body: F.when(off.isNotNull(), F.pmod(_luhn(body) + off, F.lit(10)).cast("string")).otherwise(p["tail"])
        rest = _once(F.array_join(moved, " "), lambda body: F.concat(body, tail(body)))
        return F.when(p["kind"] == "ip", _ip(p["body"], salt)).otherwise(F.concat(p["head"], rest))

    kind, whole = kind_of(value), value
    if more := max(0, tweak - LONGER + 1):
        whole = (
            F.when(kind == "name", F.regexp_replace(value, "(.)$", f"{'an' * more}$1"))
            .when(kind == "email", F.concat(F.lit("an" * more), value))
            .when(kind == "ip", value)
            .otherwise(F.concat(value, F.lit("00" * more)))
        )
    typed = F.struct(kind.alias("kind"), whole.alias("value"))
    return _once(typed, lambda p: _once(cut(p), made))


def entities(text: Column) -> Column:
    """What is found in a text, in order; empty for NULL."""
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    return F.coalesce(found, F.array().cast("array<string>"))


def _title(value: Column) -> Column:
    """The title of a name and the space behind it; nothing for other entities."""
    return F.regexp_extract(value, rf"^{_TITLE} ", 0)


def units(value: Column) -> Column:
    """What gets a surrogate of its own: each word of a name, and any other entity as a whole."""
    title = _title(value)
    words = F.split(F.substring(value, F.length(title) + 1, F.length(value)), " ")
    return F.when(title != "", words).otherwise(F.array(value))


def _units_of(text: Column) -> Column:
    return F.flatten(F.transform(entities(text), units))


def collisions(found: DataFrame, key: str, tweak: int) -> int:
    """How many of the corpus's entities (value) have a surrogate that another one has, or that is an entity itself."""
    made = found.select("value", surrogate(F.col("value"), key, tweak).alias("made"))
    same = made.groupBy("made").count().where("count > 1").agg(F.sum(F.col("count") - 1)).first()[0] or 0
    return same + made.join(found.select(F.col("value").alias("made")), "made", "left_semi").count()


def _judged(made: DataFrame, used: DataFrame) -> DataFrame:
    """(value, made, bad): bad where the surrogate is one of the used ones, or that of a smaller value."""
    first = made.groupBy("made").agg(F.min("value").alias("first"))
    hit = used.join(made.select("made"), "made", "left_semi").distinct().withColumn("hit", F.lit(True))
    bad = F.coalesce("hit", F.lit(False)) | (F.col("value") != F.col("first"))
    return stored(made.join(first, "made").join(hit, "made", "left").select("value", "made", bad.alias("bad")), "judged")


def exceptions(found: DataFrame, key: str) -> DataFrame | None:
    """(value, made) of the units (value) whose surrogate isn't that of tweak 0; None without any.

    Only units whose surrogate is taken get another tweak, round by round, until it is neither a
    unit nor another surrogate.
    """
    value = F.col("value")
    # a small table is one task else, however long its units take
    found = found.repartition(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), "value")
    every = _judged(found.select(value, surrogate(value, key).alias("made")), found.select(value.alias("made")))
    pending = every.where("bad").select("value")
    used = found.select(value.alias("made")).union(every.select("made"))
    settled = None
    for tweak in range(1, TWEAKS):
        if pending.isEmpty():
            return settled
        judged = _judged(stored(pending.select(value, surrogate(value, key, tweak).alias("made")), "tweaked"), used)
        good = judged.where("not bad").select("value", "made")
        settled = settled.union(good) if settled else good
        used = used.union(good.select("made"))
        pending = judged.where("bad").select("value")
    if not pending.isEmpty():
        raise RuntimeError(f"no free surrogates for {pending.count()} entities")
    return settled


def _name_words(held: Column, made: Column) -> Column:
    """(word, new) of the capitalised words of the names found."""
    runs = lambda v: F.regexp_extract_all(F.regexp_replace(v, rf"^{_TITLE} ", ""), F.lit(r"\p{L}+"), F.lit(0))
    pairs = F.zip_with(
        held,
        made,
        lambda v, m: F.when(
            v.rlike(rf"^{_TITLE} {_CAPITAL}"),
            F.slice(F.zip_with(runs(v), runs(m), lambda w, n: F.struct(w.alias("word"), n.alias("new"))), F.lit(1), F.size(runs(v))),
        ),
    )
    words = F.flatten(F.filter(pairs, lambda p: p.isNotNull()))
    return F.array_distinct(F.filter(words, lambda p: p["word"].rlike(r"^\p{Lu}\p{L}")))


def _mentions_replaced(piece: Column, words: Column) -> Column:
    """The text with the words of names replaced where they stand alone."""
    old = F.transform(words, lambda p: p["word"])
    runs = F.regexp_extract_all(piece, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    moved = F.transform(runs, lambda r: F.coalesce(F.get(words, (F.array_position(old, r) - 1).cast("int"))["new"], r))
    return F.when(F.size(words) > 0, F.array_join(moved, "")).otherwise(piece)


def pseudonymised(df: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """The rows with surrogates in the text; NULL stays NULL. ``count_col`` gets the number of entities.

    The words of a name found in a text are also replaced where they stand without a title in that
    text; these mentions aren't counted. No surrogate is a unit of the corpus or the surrogate of
    another one (see ``units``). Two passes over the text; units are shuffled once, distinct per task. If some need
    a tweak of their own, these are joined to the texts that hold them.
    """
    text = F.col(text_col).cast("string")
    found = df.select(F.explode(_units_of(text)).alias("value")).distinct()
    found = stored(found, "entities")
    special = exceptions(found, key)
    names = [c for c in df.columns if c != count_col] + ([count_col] if count_col else [])
    held, made, words, own = (free_name(df, c) for c in ("found", "made", "words", "own"))

    def woven(rows: DataFrame, new) -> DataFrame:
        rows = rows.withColumn(made, F.transform(held, new)).withColumn(words, _name_words(F.col(held), F.col(made)))
        pieces = F.transform(F.split(text, ENTITY, -1), lambda piece: _mentions_replaced(piece, F.col(words)))
        joined = F.array_join(F.zip_with(pieces, F.concat(made, F.array(F.lit(""))), lambda piece, new: F.concat(piece, new)), "")
        columns = {text_col: F.when(F.size(held) > 0, joined).otherwise(text)}
        if count_col:
            columns[count_col] = F.size(held).cast("long")
        return rows.withColumns(columns).select(names)

    rows = df.withColumn(held, entities(text))
    if special is None:
        return woven(rows, lambda v: surrogate(v, key))
    digest, mark = F.sha2(text, 256), free_name(df, "digest")
    holders = df.select(digest.alias(mark), F.explode(_units_of(text)).alias("value")).distinct()
    fixes = holders.join(special, "value").groupBy(mark).agg(F.collect_list(F.struct("value", "made")).alias(own))
    some = rows.where(F.size(held) > 0).withColumn(mark, digest).join(stored(fixes, "fixes"), mark, "left")
    fixed = lambda v: F.get(F.filter(F.coalesce(F.col(own), F.array().cast(fixes.schema[own].dataType)), lambda p: p["value"] == v), F.lit(0))["made"]
    made_of = lambda v: F.array_join(F.transform(units(v), lambda u: F.coalesce(fixed(u), surrogate(u, key))), " ")
    return woven(some, lambda v: F.concat(_title(v), made_of(v))).union(
        woven(rows.where(F.size(held) == 0), lambda v: surrogate(v, key))
    )
