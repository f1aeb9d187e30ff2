"""Surrogates for personal data, in DataFrame functions alone.

Entities are found by one pattern. Each distinct one gets a surrogate derived from a
secret key: of the same kind, form and, for names, gender and script. Mentions of one
entity in other forms (a number with other separators, an address in other case) get the
same surrogate. Surrogates that two entities share, or that occur in the input as an
entity, are derived again with the next attempt until none is left, so that different
entities stay different.

A name is what follows a title. Each of its words is an entity of its own: the last one a
surname, those before it given names. So a person keeps the surname whatever else is
mentioned, and capitalised words of a text that belong to one of its titled names are
replaced there too, without a title. Names never mentioned with a title are not found.

Texts are rebuilt from what lies between the mentions. Texts without entities are
returned as they are, also null and empty ones. Repeated rows get the same surrogates.
Only the text column is replaced; all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.llm.columns import own, unused
from shardstream.shared import pin

# Titles, and words of names.
_FEMALE = r"(?<!\p{L})(?:Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа)(?!\p{L})"
_MALE = r"(?<!\p{L})(?:Mr|Herr|Monsieur|Señor|Sr|Господин)(?!\p{L})"
_TITLES = r"(?:(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Господин|Госпожа|Dr|Prof)\.? ){1,4}+"
_NAME_WORD = r"\p{Lu}[\p{L}\p{M}'’-]+"
# Patterns of entities, each starting where nothing of its kind goes before.
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}(?![\w-])",
    "aws_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"\b(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?[^\s\"',;]{6,}+",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\w|\.\d)",
    "card": r"(?<![\w+-])(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}|[3-6]\d{12,18}|3\d{3}[ -]\d{6}[ -]\d{5})(?![\w-])",
    "phone": r"(?<![\w+(])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[.-])\d{3,4}[ .-]\d{3,4}(?![\w-])|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "name": rf"(?<![\p{{L}}\p{{M}}\w]){_TITLES}{_NAME_WORD}(?: {_NAME_WORD}){{0,2}}",
}
# A text in which none of this occurs has no entity.
_MAY_HAVE = r"[0-9@]|(?i:passw|pwd|secret|token|key)|AKIA|ASIA|M[rsim]|Herr|Frau|Mon|Mad|S[er]|Госп|Dr|Prof"
_SECRET_HEAD = r"^[\p{L}_-]+[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
_NAME_HEAD = f"^{_TITLES}"
# A word that may be a name's untitled mention, and what a form adds to a name.
_UNTITLED = r"(?<![\p{L}\p{M}\p{N}_])\p{Lu}[\p{L}\p{M}]++(?:['’-][\p{L}\p{M}]++)*+(?![\p{N}_])"
_NAME_TAIL = r"(?:['’]s?|-)+$"
# A secret of fewer letters and digits does not keep its form, nor does one
# that had this many attempts.
_LEAST_CHOICES, _FORM_ATTEMPTS = 8, 3
# Names by gender and script; surnames are put together from syllables.
_GIVEN = {
    ("f", "latin"): ["Alma", "Berta", "Clara", "Dina", "Elsa", "Flora", "Greta", "Hanna", "Ines", "Julia", "Karla", "Lena"],
    ("m", "latin"): ["Adam", "Bruno", "Carlo", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon"],
    ("n", "latin"): ["Alex", "Charlie", "Jules", "Kim", "Noa", "Robin", "Sam", "Sascha"],
    ("f", "cyrillic"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина"],
    ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Игорь"],
    ("n", "cyrillic"): ["Валя", "Женя", "Саша", "Слава"],
}
_SYLLABLES = {
    "latin": ["bar", "dor", "fel", "gan", "hol", "kem", "lin", "mar", "nes", "por", "rad", "sel", "tam", "ver", "win", "zor"],
    "cyrillic": ["бар", "вел", "гор", "дан", "зор", "кам", "лит", "мар", "нев", "пол", "рад", "сев", "там", "фил", "хол", "чар"],
}


def _any_pattern() -> str:
    # The card's back reference counts groups from the start: it is the only one.
    return "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())


def _kind(match: Column) -> Column:
    chain = F.when(match.rlike("^" + PATTERNS["email"] + "$"), "email")
    for kind in ("aws_key", "ssn", "ip", "card"):
        chain = chain.when(match.rlike("^(?:" + PATTERNS[kind] + ")$"), kind)
    return (
        chain.when(match.rlike(r"^[+(\d][\d() .+-]*$"), "phone").when(match.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$"), "iban")
        .when(match.rlike(_SECRET_HEAD), "secret").otherwise("name")
    )


def _entities(matches: DataFrame) -> DataFrame:
    """Split each distinct ``match`` in ``head`` and ``value``; ``canon`` is the same for one entity's forms."""
    head = F.when(F.col("kind") == "secret", F.regexp_extract("match", _SECRET_HEAD, 0)).otherwise("")
    value = F.substring(F.col("match"), F.length("head") + 1, F.length("match"))
    canon = (
        F.when(F.col("kind") == "email", F.lower("value"))
        .when(F.col("kind").isin("ssn", "card", "phone"), F.regexp_replace("value", r"\D", ""))
        .when(F.col("kind") == "iban", F.regexp_replace("value", " ", "")).otherwise(F.col("value"))
    )
    return matches.withColumn("kind", _kind(F.col("match"))).withColumn("head", head).withColumn("value", value).withColumn("canon", canon)


def _name(match: Column) -> tuple[Column, Column]:
    """The titles of a name, and its words."""
    head = F.regexp_extract(match, _NAME_HEAD, 0)
    return head, F.split(F.substring(match, F.length(head) + 1, F.length(match)), " ")


def _core(word: Column) -> Column:
    return F.regexp_replace(word, _NAME_TAIL, "")


def _name_words(mentions: DataFrame) -> DataFrame:
    """``canon`` and ``kind`` of each word of the names in each text ``key``; one kind in a text."""
    names = mentions.select("key", F.explode("matches").alias("match")).where(F.col("match").rlike(_NAME_HEAD))
    head, words = _name(F.col("match"))
    names = names.select("key", head.alias("head"), F.size(words).alias("n"), F.posexplode(words).alias("at", "word"))
    given = F.when(F.col("head").rlike(_FEMALE), "name_f").when(F.col("head").rlike(_MALE), "name_m").otherwise("name_n")
    kind = F.when(F.col("at") == F.col("n") - 1, "name").otherwise(given)
    return names.groupBy("key", F.lower(_core(F.col("word"))).alias("canon")).agg(F.min(kind).alias("kind"))


def _renamed(word: Column, names: Column) -> Column:
    """The word's surrogate out of ``names``, in the word's form; null if it is none."""
    core = _core(word)
    new = names[F.lower(core)]
    new = F.when(core == F.upper(core), F.upper(new)).otherwise(F.initcap(new))
    return F.concat(new, F.substring(word, F.length(core) + 1, F.length(word)))


def _renamed_name(match: Column, names: Column) -> Column:
    head, words = _name(match)
    return F.concat(head, F.array_join(F.transform(words, lambda w: _renamed(w, names)), " "))


def _renamed_untitled(word: Column, names: Column) -> Column:
    """The word with a surrogate for it or for what hyphens part in it."""
    pieces = F.transform(F.split(word, "-"), lambda p: F.coalesce(_renamed(p, names), p))
    return F.coalesce(_renamed(word, names), F.when(word.contains("-"), F.array_join(pieces, "-")), word)


def _draw(seed: Column, at: Column | int, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, F.lit(at) if isinstance(at, int) else at), F.lit(n)).cast("int")


def _letter(letters: str, seed: Column, at: Column) -> Column:
    return F.substring(F.lit(letters), _draw(seed, at, len(letters)) + 1, F.lit(1))


def _same_form(text: Column, seed: Column) -> Column:
    """Letters for letters of the same case, digits for digits; hexadecimal stays so."""
    lower = F.when(text.rlike("^(?:[0-9a-f]*|[0-9A-F]*)$"), F.lit("abcdef")).otherwise(F.lit("abcdefghijklmnopqrstuvwxyz"))

    def one(c: Column, i: Column) -> Column:
        letter = F.substring(lower, F.pmod(F.xxhash64(seed, i), F.length(lower)).cast("int") + 1, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), _letter("0123456789", seed, i)).when(c.rlike(r"\p{Lu}"), F.upper(letter))
            .when(c.rlike(r"\p{Ll}"), letter).otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _secret(canon: Column, form: Column, seed: Column) -> Column:
    """``form`` where it changes every letter and leaves choices enough; else letters and
    digits from the key, one more with each attempt."""
    choices = F.length(F.regexp_replace(canon, r"[^0-9\p{Lu}\p{Ll}]", ""))
    keeps = canon.rlike(r"^[!-~\p{Lu}\p{Ll}]*$") & (choices >= _LEAST_CHOICES) & (F.col("attempt") < _FORM_ATTEMPTS)
    at = F.sequence(F.lit(1), F.greatest(F.length(canon), F.lit(12)) + F.col("attempt"))
    drawn = F.array_join(F.transform(at, lambda i: _letter("abcdefghijklmnopqrstuvwxyz0123456789", seed, i)), "")
    return F.when(keeps, form).otherwise(drawn)


def _luhn(digits: Column) -> Column:
    """The check sum modulo 10 of a string of digits, the last one not doubled."""

    def add(total: Column, c: Column) -> Column:
        n = c["d"].cast("int") * F.when(c["i"] % 2 == 1, 2).otherwise(1)
        return total + n - F.when(n > 9, 9).otherwise(0)

    indexed = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    return F.pmod(F.aggregate(indexed, F.lit(0), add), F.lit(10))


def _surrogate(key: str) -> Column:
    """The surrogate's canonical form for ``kind``, ``canon`` and ``attempt``."""
    canon, kind = F.col("canon"), F.col("kind")
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, F.col("attempt").cast("string")), 256)
    form = _same_form(canon, seed)
    domain = F.concat(
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: _letter("abcdefghijklmnopqrstuvwxyz", seed, -i)), ""),
        F.lit(".example."), F.when(canon.rlike(r"\.(?:com|net|org)$"), F.substring_index(canon, ".", -1)).otherwise("com"),
    )
    email = F.concat(_same_form(F.substring_index(canon, "@", 1), seed), F.lit("@"), domain)
    head = F.concat(F.substring(canon, 1, 1), F.substring(form, F.lit(2), F.length(canon) - 2))
    # The last digit keeps the check sum what it was.
    last = F.pmod(_luhn(canon) - _luhn(F.concat(head, F.lit("0"))), F.lit(10)).cast("string")
    ip = F.concat_ws(".", (_draw(seed, 0, 222) + 1).cast("string"), *(_draw(seed, i, 256).cast("string") for i in (1, 2, 3)))
    syllables = {script: F.array(*map(F.lit, parts)) for script, parts in _SYLLABLES.items()}
    cyrillic = canon.rlike(r"\p{IsCyrillic}")
    parts = F.when(cyrillic, syllables["cyrillic"]).otherwise(syllables["latin"])

    def put_together(n: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.get(parts, _draw(seed, i, 16))), "")

    gender = F.substring(kind, 6, 1)
    names = F.lit(None)
    for (g, script), listed in _GIVEN.items():
        names = F.when((gender == g) & (cyrillic if script == "cyrillic" else ~cyrillic), F.array(*map(F.lit, listed))).otherwise(names)
    given = F.lower(F.get(names, F.pmod(F.xxhash64(seed, F.lit(0)), F.size(names)).cast("int")))
    given = F.when(F.col("attempt") == 0, given).otherwise(F.concat(given, put_together(F.col("attempt") + 1)))
    name = F.when(kind == "name", put_together(F.col("attempt") + 4)).otherwise(given)
    country = F.when(F.length(canon) > 10, F.substring(canon, F.lit(1), F.length(canon) - 10)).otherwise("")
    area = F.concat(_letter("23456789", seed, F.lit(-1)), F.substring(form, F.length(country) + 2, F.length(canon)))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", F.concat(head, last))
        .when(kind == "aws_key", F.concat(F.substring(canon, 1, 4), F.substring(form, 5, 16)))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(form, 2, 8)))
        .when(kind == "phone", F.concat(country, area)).when(kind == "iban", F.concat(F.substring(canon, 1, 2), F.substring(form, 3, 40)))
        .when(kind.startswith("name"), name).otherwise(_secret(canon, form, seed))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``canon`` and ``surrogate`` of each distinct entity, no two alike."""
    entities = pin(entities.select("kind", "canon").distinct(), "entities")
    table = entities.withColumn("attempt", F.lit(0))
    while True:
        table = pin(table.withColumn("surrogate", _surrogate(key)), "surrogates")
        first = table.groupBy("surrogate").agg(F.min(F.struct("attempt", "kind", "canon")).alias("first"))
        real = entities.select(F.col("canon").alias("surrogate"), F.lit(True).alias("real")).distinct()
        checked = table.join(first, "surrogate").join(real, "surrogate", "left")
        wrong = F.col("real").isNotNull() | (F.struct("attempt", "kind", "canon") != F.col("first"))
        checked = pin(checked.select("kind", "canon", "surrogate", "attempt", wrong.alias("wrong")), "checked")
        if checked.where("wrong").isEmpty():
            return checked.select("kind", "canon", "surrogate")
        table = checked.select("kind", "canon", (F.col("attempt") + F.col("wrong").cast("int")).alias("attempt"))


def _rendered() -> Column:
    """The surrogate in the form of the mention ``head`` + ``value``."""
    value, new = F.col("value"), F.col("surrogate")

    def put(allowed: str) -> Column:
        before = lambda i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), f"[^{allowed}]", ""))
        return F.array_join(
            F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike(f"[{allowed}]"), F.substring(new, before(i), F.lit(1))).otherwise(c)), ""
        )

    rendered = F.when(F.col("kind").isin("ssn", "card", "phone"), put("0-9")).when(F.col("kind") == "iban", put("A-Z0-9"))
    return F.concat("head", rendered.otherwise(new))


def replace_entities(docs: DataFrame, key: str = "surrogates", text: str = "text", count: str = "__entities") -> DataFrame:
    """The documents with ``text`` replaced and ``count`` (how many mentions were) added.

    Where the documents have a column of that name it stays, and underscores are put behind
    the new one's.
    """
    count, row_key, row_new, row_names = (unused(docs, name) for name in (count, "__key", "__new", "__names"))
    pattern, here = _any_pattern(), own(text)
    may_have = F.coalesce(here.rlike(_MAY_HAVE), F.lit(False))
    some = docs.where(may_have).select(here.alias("text"))
    mentions = some.select(F.md5("text").alias("key"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("matches"))
    mentions = pin(mentions.where(F.size("matches") > 0).distinct(), "mentions")
    entities = pin(_entities(mentions.select(F.explode("matches").alias("match")).distinct()).where("kind <> 'name'"), "mentioned")
    words = pin(_name_words(mentions), "name-words")
    new = surrogates(entities.select("kind", "canon").unionByName(words.select("kind", "canon")), key)
    made = entities.join(new, ["kind", "canon"]).select("match", _rendered().alias("new"))
    names = words.join(new, ["kind", "canon"]).groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("canon", "surrogate"))).alias("names")
    )
    # A name's words are looked up in its own text; it has no replacement of its own.
    placed = mentions.select("key", F.posexplode("matches").alias("at", "match")).join(pin(made, "replacements"), "match", "left")
    mention = F.struct("at", F.when(F.col("new").isNull(), F.col("match")).alias("name"), "new")
    placed = placed.groupBy("key").agg(F.sort_array(F.collect_list(mention)).alias("new")).join(names, "key", "left")
    fresh = F.transform("new", lambda m: F.coalesce(m["new"], _renamed_name(m["name"], F.col("names"))))
    placed = pin(placed.select(F.col("key").alias(row_key), fresh.alias(row_new), F.col("names").alias(row_names)), "placed")

    def untitled(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit(_UNTITLED), F.lit(0))

    def renamed(part: Column) -> Column:
        put = lambda rest, word: F.concat(rest, F.coalesce(_renamed_untitled(word, F.col(row_names)), F.lit("")))
        return F.array_join(F.zip_with(F.split(part, _UNTITLED, -1), untitled(part), put), "")

    between = F.split(here, pattern, -1)
    between = F.when(F.col(row_names).isNotNull(), F.transform(between, renamed)).otherwise(between)
    parts = F.zip_with(between, row_new, lambda part, new: F.concat(part, F.coalesce(new, F.lit(""))))
    changed = docs.where(may_have).withColumn(row_key, F.md5(here)).join(placed, row_key, "left")
    other = F.flatten(F.transform(F.split(here, pattern, -1), untitled))
    other = F.size(F.filter(other, lambda w: _renamed_untitled(w, F.col(row_names)) != w))
    mentioned = F.coalesce(F.size(row_new), F.lit(0)) + F.when(F.col(row_names).isNotNull(), other).otherwise(0)
    replaced = F.when(F.col(row_new).isNotNull(), F.array_join(parts, "")).otherwise(here).alias(text)
    rows = changed.select(*(replaced if name == text else own(name) for name in docs.columns), mentioned.alias(count))
    return rows.unionByName(docs.where(~may_have).withColumn(count, F.lit(0)))
