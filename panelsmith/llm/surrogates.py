"""Surrogates for personal data (DataFrame functions only).

Mentions of e-mail addresses, phone numbers, grouped ids (3-2-4 digits), card
numbers, IP addresses and names after a title are found by one pattern; where a
text names a surname after a title, its capitalised mentions without one in the
same text follow. Mentions of one entity share a key (an address in lower case,
the digits of a number, a name in lower case), and an entity gets one surrogate
in the whole corpus: a keyed hash of kind and key, shaped like the entity.
Numbers keep their layout and leading digit, cards a valid check digit,
addresses their letters-and-digits pattern and top-level domain, names their
gender, script and case. Surrogates that two entities share, or that are
themselves an entity of the corpus, are drawn again for all but the first, a
round per attempt, until none is left: distinct entities stay distinct. The
space drawn from grows with the attempt (longer names and hosts; numbers keep
their length for SAME_LENGTH attempts, then grow), so the rounds end for any
number of entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelsmith.session import cut_lineage

_MALE = "Mr|Sir|Herr|Herrn|Monsieur|Señor|Sr|Don|Господин|господин"
_FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|Doña|Госпожа|госпожа"
_NEUTRAL = "Dr|Prof|Doctor|Professor"
_TITLES = f"{_MALE}|{_FEMALE}|{_NEUTRAL}"
_INITIALS = r"(?:\p{Lu}\. ){0,2}"
#: A genitive's 's is not part of the name.
_WORD = r"\p{Lu}(?:[\p{L}-]|['’](?!s\b)){1,40}"
#: Tested first, since looking back is dear; a title is not a name (Frau Dr. ...).
_NAME_BEGINS = rf"(?=\p{{Lu}})(?!(?:{_NEUTRAL})\b)"


def _given(titles: str) -> str:
    return rf"{_NAME_BEGINS}(?<=\b(?:{titles})\.? ){_WORD}(?= {_INITIALS}\p{{Lu}}\p{{L}})"


#: Kinds in the order of the pattern's groups.
KINDS = ("email", "phone", "id", "card", "ip", "given_m", "given_f", "given_n", "surname")
PLAIN, NAMES, NUMBERS = KINDS[:5], KINDS[5:], ("phone", "id", "card")
_ADDRESSES = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "|".join(
        (
            r"(?<![\w+])\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)",
            r"(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\w)",
            r"(?<![\w+])\+[1-9]\d{7,14}(?!\w)",
            r"(?<![\w.+-])(?:\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})(?![\w-]|\.\d)",
        )
    ),
    r"(?<![\w.+-])\d{3}-\d{2}-\d{4}(?![\w-]|\.\d)",
    r"(?<!\w)(?:\d{4}(?:[ -]?\d{4}){3}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?!\w)",
    r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)"
    r"|(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])",
)
_NAMES = (
    _given(_MALE),
    _given(_FEMALE),
    _given(_NEUTRAL),
    # after the title, and a given name or initials if there are any
    rf"{_NAME_BEGINS}(?<=\b(?:{_TITLES})\.? (?:\p{{Lu}}[\p{{L}}'’-]{{1,40}} )?(?:\p{{Lu}}\. ){{0,2}}){_WORD}",
)
PATTERN = "|".join(f"({p})" for p in _ADDRESSES + _NAMES)
#: The same groups for texts without a title: looking back for one is dear.
NO_NAMES = "|".join([f"({p})" for p in _ADDRESSES] + ["((?!))"] * len(_NAMES))
_FIRST = "".join(sorted({t[0] for t in _TITLES.split("|")}))
TITLE = rf"\b(?=[{_FIRST}])(?:{_TITLES})\.? \p{{Lu}}"
#: What a text without a title must hold for the other patterns.
PLAIN_SIGN = "[0-9@]|[A-Fa-f]:[A-Fa-f]"
#: Between words, for surnames that are mentioned again.
WORD_EDGE = r"(?<![\p{L}'’-])(?=\p{Lu})|(?<=[\p{L}'’-])(?![\p{L}'’-])"
#: Attempts in which a number's surrogate has the number's length.
SAME_LENGTH = 8

GIVEN = {
    ("given_m", "latin"): "Adrian Bruno Carl Daniel Emil Felix Gabriel Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul Quentin Robert Simon Thomas".split(),
    ("given_f", "latin"): "Alice Berta Clara Diana Emma Flora Greta Helena Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sara Teresa Vera".split(),
    ("given_n", "latin"): "Alex Andrea Charlie Dominique Eden Jamie Jordan Kim Morgan Noel Quinn Robin Sasha Taylor Toni".split(),
    ("given_m", "cyrillic"): "Алексей Борис Виктор Григорий Дмитрий Егор Иван Кирилл Максим Павел".split(),
    ("given_f", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Ксения Мария Ольга Татьяна".split(),
    ("given_n", "cyrillic"): "Саша Женя Валя Слава Шура".split(),
}
#: Endings of given names made of syllables.
ENDINGS = {
    ("given_m", "latin"): "n",
    ("given_f", "latin"): "na",
    ("given_n", "latin"): "",
    ("given_m", "cyrillic"): "н",
    ("given_f", "cyrillic"): "на",
    ("given_n", "cyrillic"): "",
}
SYLLABLES = {
    "latin": "ba da fe go hi ka le mo ni ra se ti vo we zu lan".split(),
    "cyrillic": "ба да фе го ми ка ле мо ни ра се ти во зу жи лан".split(),
}


def _hash(secret: str, kind: Column, key: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(secret), kind, key, attempt.cast("string")), 256)


def _digits(h: Column) -> Column:
    """64 decimal digits from 64 hexadecimal ones."""
    return F.translate(h, "abcdef", "024687")


def _number(h: Column, place: int, size: Column | int) -> Column:
    """A number below ``size`` from four hex digits of the hash."""
    return F.conv(F.substring(h, place, 4), 16, 10).cast("bigint") % size


def _pick(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number + 1).cast("int"))


def _syllables(h: Column, script: str, count: Column | int, place: int) -> Column:
    return F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.lit(count) - 1 if isinstance(count, int) else (count - 1).cast("int")),
            lambda i: _pick(SYLLABLES[script], F.conv(F.substring(h, F.lit(place) + i % 20, F.lit(1)), 16, 10).cast("bigint")),
        ),
        "",
    )


def _reshaped(text: Column, h: Column) -> Column:
    """Letters for letters and digits for digits; other characters stay."""
    return F.array_join(
        F.transform(
            F.split(text, ""),
            lambda c, i: F.when(c.rlike("[0-9]"), F.substring(_digits(h), i % 60 + 1, F.lit(1)))
            .when(c.rlike("[A-Za-z]"), F.translate(F.substring(h, i % 60 + 1, F.lit(1)), "0123456789", "ghiklmnopr"))
            .otherwise(c),
        ),
        "",
    )


def _luhn(digits: Column) -> Column:
    """The check sum modulo 10 of a string of digits; 0 is valid."""

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return F.when(twice & (d > 4), 2 * d - 9).when(twice, 2 * d).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10


def surrogate(secret: str, kind: Column, key: Column, attempt: Column) -> Column:
    """The surrogate key of an entity at the given attempt (from 0)."""
    h = _hash(secret, kind, key, attempt)
    host = F.substring(_digits(h), F.lit(38), F.least(3 * attempt + 4, F.lit(26)))
    email = F.concat(_reshaped(F.substring_index(key, "@", 1), h), F.lit("@host"), host, F.lit("."), F.substring_index(key, ".", -1))
    longer = F.least(F.greatest(attempt - (SAME_LENGTH - 1), F.lit(0)), F.lit(40))
    number = F.concat(F.substring(key, 1, 1), F.substring(_digits(h), F.lit(2), F.length(key) - 1 + longer))
    body = F.substring(number, F.lit(1), F.length(number) - 1)
    checked = F.concat(body, ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string"))
    number = F.when((kind == "card") & (_luhn(key) == 0), checked).otherwise(number)
    more = F.when(longer > 0, F.concat(F.lit("."), F.substring(_digits(h), F.lit(20), longer))).otherwise("")
    ip = F.concat(F.concat_ws(".", *[(_number(h, p, 254) + 1).cast("string") for p in (1, 5, 9, 13)]), more)
    ip6 = F.concat(F.lit("2001:db8:"), F.concat_ws(":", *[F.substring(h, p, 4) for p in range(1, 25, 4)]))
    cyrillic = key.rlike(r"^\p{IsCyrillic}")
    name = F.lit(None).cast("string")
    for (k, script), names in GIVEN.items():
        made = F.concat(_syllables(h, script, F.least(attempt + 1, F.lit(20)), 20), F.lit(ENDINGS[k, script]))
        fits = (kind == k) & (cyrillic if script == "cyrillic" else ~cyrillic)
        name = F.when(fits, F.when(attempt == 0, _pick(names, _number(h, 1, len(names)))).otherwise(made)).otherwise(name)
    for script in SYLLABLES:
        fits = (kind == "surname") & (cyrillic if script == "cyrillic" else ~cyrillic)
        name = F.when(fits, _syllables(h, script, F.least(attempt + 3, F.lit(20)), 1)).otherwise(name)
    ips = F.when(key.contains(":"), ip6).otherwise(ip)
    return F.when(kind == "email", email).when(kind.isin(*NUMBERS), number).when(kind == "ip", ips).otherwise(F.lower(name))


def entity_key(kind: Column, mention: Column) -> Column:
    return F.when(kind.isin(*NUMBERS), F.regexp_replace(mention, "[^0-9]", "")).otherwise(F.lower(mention))


def assign_surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """(kind, key, surrogate) of distinct ``entities`` (kind, key), one to one
    within a kind, and no surrogate is a key of its kind."""
    todo = cut_lineage(entities.withColumn("attempt", F.lit(0)), "surrogate-entities")
    taken = todo.select("kind", F.col("key").alias("surrogate"))
    done = None
    while True:
        drawn = cut_lineage(todo.withColumn("surrogate", surrogate(secret, F.col("kind"), F.col("key"), F.col("attempt"))), "surrogate-draws")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("key").alias("key")).join(taken, ["kind", "surrogate"], "left_anti")
        good = cut_lineage(first.select("kind", "key", "surrogate"), "surrogate-done")
        done = good if done is None else done.unionByName(good)
        taken = taken.unionByName(good.select("kind", "surrogate"))
        left = drawn.join(good.select("kind", "key"), ["kind", "key"], "left_anti")
        todo = cut_lineage(left.select("kind", "key", (F.col("attempt") + 1).alias("attempt")), "surrogate-todo")
        if todo.isEmpty():
            return done


def _cased(mention: Column, value: Column) -> Column:
    """A name's surrogate in the case of the mention."""
    upper = (mention == F.upper(mention)) & (mention != F.lower(mention)) & (F.length(mention) > 1)
    return F.when(upper, F.upper(value)).otherwise(F.initcap(value))


def _shown(kind: Column, mention: Column, value: Column) -> Column:
    """A surrogate key in the layout and case of the mention."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    laid_out = F.aggregate(
        F.split(mention, ""),
        start,
        lambda s, c: F.struct(
            F.concat(s["out"], F.when(c.rlike("[0-9]"), F.substring(value, s["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (s["n"] + c.rlike("[0-9]").cast("int")).alias("n"),
        ),
        # a number that had to grow has its further digits at the end
        lambda s: F.concat(s["out"], F.substring(value, s["n"] + 1, F.length(value))),
    )
    upper = (mention == F.upper(mention)) & (mention != F.lower(mention))
    return (
        F.when(kind.isin(*NUMBERS), laid_out).when(kind.isin(*NAMES), _cased(mention, value)).when(upper, F.upper(value)).otherwise(value)
    )


def replace_personal(
    docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep``, ``text_col`` with its
    mentions replaced, changed (boolean), and per kind the number of mentions
    (n_email, n_phone, n_id, n_card, n_ip, n_name; the last counts names after
    titles, not their other mentions).

    A text without mentions stays as it is; a null text stays null. Ids may be
    null or repeat: equal texts get equal results. A very long text is handled
    whole, by one task. Digits beyond 62 of one number do not occur in its
    patterns. ``keep`` may not name a column of the result. An empty table
    gives an empty result.
    """
    clash = set(keep) & {id_col, text_col, "changed", "n_name", *[f"n_{k}" for k in PLAIN]}
    if clash:
        raise ValueError(f"keep names columns of the result: {sorted(clash)}")
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("s_id"), F.struct(*keep).alias("s_kept") if keep else F.lit(0).alias("s_kept"), text.alias("s_text"), F.sha2(text, 256).alias("s_digest")
    )
    # cheap tests first: a pattern is only tried where a title, a digit or an
    # at sign occurs
    titled, plain = F.col("s_text").rlike(TITLE), F.col("s_text").rlike(PLAIN_SIGN)

    def by_title(f) -> Column:
        return F.when(titled, f(PATTERN)).otherwise(f(NO_NAMES))

    found = F.when(titled, F.col("s_text").rlike(PATTERN)).when(plain, F.col("s_text").rlike(NO_NAMES))
    is_hit = F.coalesce(found, F.lit(False))
    hits = rows.where(is_hit)
    groups = [by_title(lambda p, g=g: F.regexp_extract_all("s_text", F.lit(p), F.lit(g + 1))).alias(k) for g, k in enumerate(KINDS)]
    zipped = F.arrays_zip(*groups)
    kind = F.array_max(F.array(*[F.when(F.col("m")[k] != "", F.lit(k)) for k in KINDS]))
    mentions = (
        hits.select("s_digest", F.posexplode_outer(zipped).alias("pos", "m"))
        .where("m is not null")
        .select("s_digest", "pos", kind.alias("kind"), F.concat_ws("", *[F.col("m")[k] for k in KINDS]).alias("mention"))
        .groupBy("s_digest", "pos")  # equal texts once
        .agg(F.first("kind").alias("kind"), F.first("mention").alias("mention"))
        .withColumn("key", entity_key(F.col("kind"), F.col("mention")))
    )
    mentions = cut_lineage(mentions, "surrogate-mentions")
    assigned = assign_surrogates(mentions.select("kind", "key").distinct(), secret)
    shown = mentions.join(assigned, ["kind", "key"]).select(
        "s_digest", "pos", "kind", "key", "surrogate", _shown(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("shown")
    )
    per_text = shown.groupBy("s_digest").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "shown"))), lambda x: x["shown"]).alias("shown"),
        *[F.sum((F.col("kind") == k).cast("bigint")).alias(f"n_{k}") for k in PLAIN],
        F.map_from_entries(F.collect_set(F.when(F.col("kind") == "surname", F.struct("key", "surrogate")))).alias("surnames"),
        F.sum(F.col("kind").isin(*NAMES).cast("bigint")).alias("n_name"),
    )
    counts = [f"n_{k}" for k in PLAIN] + ["n_name"]

    def again(word: Column) -> Column:
        name = F.regexp_replace(word, "['’]s$", "")
        value = F.element_at("surnames", F.lower(name))
        named = F.concat(_cased(name, value), F.substring(word, F.length(name) + 1, F.lit(2)))
        return F.when(word.rlike(r"^\p{Lu}") & value.isNotNull(), named).otherwise(word)

    def between(piece: Column) -> Column:
        named = F.array_join(F.transform(F.split(piece, WORD_EDGE, -1), again), "")
        return F.when(F.size("surnames") > 0, named).otherwise(piece)

    rebuilt = F.array_join(
        F.zip_with(by_title(lambda p: F.split("s_text", p, -1)), "shown", lambda piece, s: F.concat(between(piece), F.coalesce(s, F.lit("")))), ""
    )
    changed = hits.join(per_text, "s_digest").select("s_id", "s_kept", rebuilt.alias("s_text"), F.lit(True).alias("changed"), *counts)
    same = rows.where(~is_hit).select("s_id", "s_kept", "s_text", F.lit(False).alias("changed"), *[F.lit(0).cast("bigint").alias(c) for c in counts])
    return changed.unionByName(same).select(
        F.col("s_id").alias(id_col), *[F.col("s_kept")[c].alias(c) for c in keep], F.col("s_text").alias(text_col), "changed", *counts
    )
