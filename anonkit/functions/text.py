"""Rules that find personal data in free text and put a label in its place.

Each rule is one ``regexp_replace`` with a literal pattern, compiled once per
task. Patterns use explicit look-around for ASCII word edges, because ``\\b``
means other things in other Java versions. All quantifiers are bounded, or
possessive, or start only where a run of their characters starts, so the time
for a text is proportional to its length.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels that replace personal data.
LABELS = ("[NAME]", "[EMAIL]", "[PHONE]", "[ADDRESS]", "[DOB]", "[ID]", "[CARD]", "[IP]")

_START = r"(?<![0-9A-Za-z_])"
_NOT_IN_WORD = r"(?<![\p{L}0-9_])"
_END = r"(?![0-9A-Za-z_])"
_LOCAL = r"[\p{IsLatin}0-9._%+-]"


_WORD = r"\p{Lu}[\p{L}'-]*+"

# Months in English, German, French, Spanish and Dutch.
MONTHS = (
    "January|February|March|April|May|June|July|August|September|October|November|December"
    "|Januar|Februar|März|Mai|Juni|Juli|Oktober|Dezember"
    "|janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre"
    "|enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre"
    "|januari|februari|maart|april|mei|juni|juli|augustus|september|oktober|november|december"
)
_YEAR = "(?:19|20)[0-9]{2}"
_DATE = (
    rf"(?:{_YEAR}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}[/.-][0-9]{{1,2}}[/.-]{_YEAR}"
    rf"|[0-9]{{1,2}}(?:st|nd|rd|th|er|[.])? (?:de )?(?:{MONTHS})(?: de)? {_YEAR}|(?:{MONTHS}) [0-9]{{1,2}}(?:st|nd|rd|th)?,? {_YEAR})"
)

# Words that make a date a birth date (before it; as its name behind it, and what may stand between),
# kinds of streets, and particles inside names.
BIRTH_WORDS = (
    "born|birth|birthday|birthdate|date of birth|dob|geboren|geb[.]|geburtsdatum|née|né|naissance|nacida|nacido|nacimiento|geboortedatum"
)
BIRTH_NAMES = "date of birth|birthday|birthdate|dob|geburtsdatum|geburtstag|date de naissance|fecha de nacimiento|geboortedatum"
COPULAS = "is|was|ist|war|est|était|es|era"
OWNERS = "my|his|her|their|the|customer's|mein|sein|ihr|das|ma|sa|la|mi|su|mijn|de"
_BIRTH = rf"(?<![0-9A-Za-z_\[])(?i:{BIRTH_WORDS})(?![\p{{L}}0-9_])"
_WHOLE_DATE = rf"(?<![0-9A-Za-z_]){_DATE}{_END}"
# The rest of a sentence up to the next birth word, date or [DOB]; it stops there, so no text is read twice.
_UP_TO_BIRTH_OR_DATE = rf"(?:(?!{_BIRTH}|{_WHOLE_DATE}|\[DOB\])(?:[^.;!?\n]|[.](?=\S)))*+"
STREETS = "Street|Road|Avenue|Lane|Square"
STREETS_FIRST = "Calle|Avenida|Plaza|Paseo|Camino"
STREET_ENDINGS = "straße|strasse|weg|platz|allee|gasse|straat|laan|plein|gracht|kade"
STREETS_FRENCH = "rue|avenue|boulevard|place|chemin|allée|impasse|quai"
PARTICLES = "de|del|della|da|dos|das|di|du|la|las|le|los|van|von|der|den|ten|ter|zu|y|e|bin|ibn"


@dataclass(frozen=True)
class Rule:
    """A pattern, its label, and a cheap test that every text it matches passes.

    The test is a substring of which one must occur (``needs``), then one or two
    short patterns without look-around (``hint``, ``second_hint``). Most texts
    fail it and are spared the slower search. A rule with ``digits`` matches
    only texts that hold a digit, so the others are not tested for it.
    """

    name: str
    label: str
    pattern: str
    needs: tuple[str, ...] = ()
    hint: str | None = None
    second_hint: str | None = None
    keeps_group: bool = False
    digits: bool = True

    def applied_to(self, text: Column) -> Column:
        replacement = ("$1" if self.keeps_group else "") + self.label
        return F.regexp_replace(text, self.pattern, replacement)

    def may_match(self, text: Column) -> Column:
        tests = [text.rlike(hint) for hint in (self.hint, self.second_hint) if hint]
        if self.needs:
            tests.insert(0, reduce(lambda a, b: a | b, [F.contains(text, F.lit(s)) for s in self.needs]))
        return reduce(lambda a, b: a & b, tests)


# The rules, in the order they are applied. Accounts and cards come
# first so that a long number is not taken for a phone; addresses and ids last.
RULES = (
    Rule(
        "bank_account",
        "[CARD]",
        r"(?=[A-Z])" + _START + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _END,
        hint=r"[A-Z]{2}[0-9]{2}",
    ),
    Rule(
        "card_number",
        "[CARD]",
        r"(?=[0-9])" + _START + r"(?:[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"
        r"|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})" + _END,
        hint=r"[0-9]{4}[ -]?[0-9]{4}",
    ),
    Rule(
        "email",
        "[EMAIL]",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[\p{{IsLatin}}0-9.-]+[.]\p{{IsLatin}}{{2,}}",
        needs=("@",),
        digits=False,
    ),
    Rule(
        "ip_address",
        "[IP]",
        r"(?=[0-9])" + _START + r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}" + _END,
        hint=r"[0-9][.][0-9]{1,3}[.][0-9]",
    ),
    Rule(
        "birth_date",
        "[DOB]",
        rf"({_BIRTH}{_UP_TO_BIRTH_OR_DATE}){_WHOLE_DATE}",
        hint=_YEAR,
        second_hint=rf"(?i:{BIRTH_WORDS})",
        keeps_group=True,
    ),
    Rule("birth_date_or", "[DOB]", rf"(\[DOB\] (?:or|oder|ou|o|of|/) ){_DATE}" + _END, needs=("[DOB] ",), keeps_group=True),
    Rule(
        "birth_date_before",
        "[DOB]",
        # the date is called a birth date, and by nothing else: "2024-05-01, birthday gift" is none
        rf"{_WHOLE_DATE}(?=(?: (?:{COPULAS}))?[,(:-]{{0,1}} ?[(]?(?:(?i:{OWNERS}) ){{0,2}}(?i:{BIRTH_NAMES})"
        rf"(?: of [\p{{L}}' -]{{1,60}})?(?:[).,;:!?\n]|$))",
        hint=_YEAR,
        second_hint=rf"(?i:{BIRTH_NAMES})",
    ),
    Rule(
        "phone_international",
        "[PHONE]",
        r"[+][0-9]{1,3}[ .-]?[(]?[0-9]{1,4}[)]?(?:[ .-]?[0-9]{2,4}){2,4}",
        needs=("+",),
    ),
    Rule("phone_area_code", "[PHONE]", r"[(]0[0-9]{1,4}[)][ -]{0,2}[0-9]{4,8}" + _END, needs=("(0",)),
    Rule(
        "phone_plain",
        "[PHONE]",
        r"(?=[0-9])" + _START + r"[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}" + _END,
        hint=r"[0-9]{3}[.-][0-9]{3}",
    ),
    Rule(
        "address",
        "[ADDRESS]",
        rf"(?=[0-9]){_START}[0-9]++[A-Za-z]? {_WORD} (?:(?!(?:{STREETS}){_END}){_WORD} )*+(?:{STREETS}){_END}(?:, {_WORD})?",
        needs=tuple(STREETS.split("|")),
    ),
    Rule(
        "address_street_first",
        "[ADDRESS]",
        rf"{_NOT_IN_WORD}(?:{STREETS_FIRST}) (?:(?:de|del|la|las|los|el) )*+{_WORD}(?: (?:(?:de|del|la|las|los|el) )*+{_WORD})*+,? [0-9]++[A-Za-z]?{_END}",
        needs=tuple(f"{s} " for s in STREETS_FIRST.split("|")),
    ),
    Rule(
        "address_street_inside",
        "[ADDRESS]",
        rf"{_NOT_IN_WORD}\p{{Lu}}\p{{L}}*(?:{STREET_ENDINGS}) [0-9]++[A-Za-z]?{_END}",
        needs=tuple(f"{s} " for s in STREET_ENDINGS.split("|")),
        hint=rf"(?:{STREET_ENDINGS}) [0-9]",
    ),
    Rule(
        "address_number_first",
        "[ADDRESS]",
        rf"(?=[0-9]){_START}[0-9]++(?: bis| ter)?,? (?:{STREETS_FRENCH}) (?:(?:de|du|des|la|le|les) )*+(?:[dl]')?{_WORD}(?: {_WORD})*+",
        needs=tuple(f" {s} " for s in STREETS_FRENCH.split("|")),
        hint=rf"[0-9rs],? (?:{STREETS_FRENCH}) ",
    ),
    Rule(
        "introduced_name",
        "[NAME]",
        rf"{_START}([Mm]y name is ){_WORD}(?: (?:(?:{PARTICLES}) )*+{_WORD})*+",
        needs=("y name is ",),
        keeps_group=True,
        digits=False,
    ),
    Rule("customer_id", "[ID]", r"CUST-[0-9]{6,}+", needs=("CUST-",)),
    Rule(
        "passport",
        "[ID]",
        _START + r"([Pp]assport(?: number| no[.]?)?:? )[A-Z]{0,2}[0-9]{6,}+" + _END,
        needs=("assport",),
        keeps_group=True,
    ),
    Rule(
        "national_id",
        "[ID]",
        r"(?=[0-9A-Z])" + _START + r"(?:(?:[0-9]{8}|[XYZ][0-9]{7})-?[A-Z]|[0-9]{7}[A-W][A-IW]?"
        r"|[A-Z]{2} ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[A-D]|[0-9]{3}-[0-9]{2}-[0-9]{4})" + _END,
        hint=r"[0-9]{2}[ -]?[0-9]{2}",
    ),
)

# Columns of the same row whose values are looked for in its note, with their label.
# A value that can contain another one stands before it.
KNOWN_VALUE_LABELS = (
    ("email", "[EMAIL]"),
    ("street_address", "[ADDRESS]"),
    ("full_name", "[NAME]"),
    ("phone", "[PHONE]"),
)


def rules_for(label: str) -> tuple[Rule, ...]:
    return tuple(r for r in RULES if r.label == label)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it.

    A lambda variable stands for the value. Written out instead, each use would
    repeat the whole expression, and a chain of rules would grow exponentially
    as soon as the optimizer moves a filter through it.
    """
    return F.transform(F.array(value), body)[0]


def redact_rules(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The whole text after all ``rules``, one after the other. NULL stays NULL."""

    def step(current: Column, rule: Rule) -> Column:
        return _once(current, lambda t: F.when(rule.may_match(t), rule.applied_to(t)).otherwise(t))

    # one test for all of them; no rule puts a digit into a text
    wordy = tuple(r for r in rules if not r.digits)
    if len(rules) - len(wordy) < 2:
        return reduce(step, rules, text)
    return _once(text, lambda t: F.when(t.rlike("[0-9]"), reduce(step, rules, t)).otherwise(reduce(step, wordy, t)))


def _as_token(value: Column) -> Column:
    """Pattern for a value as a token of its own, with all its signs quoted.

    Where the value begins or ends with a letter or digit, none may stand before or behind it, so a short value
    never cuts another number or name. An order id is a token as a whole.
    """
    quoted = F.regexp_replace(value, r"([^\p{L}\p{N} ])", r"\\$1")
    inside = r"[\p{L}\p{N}_]"
    return F.concat(
        F.lit(rf"(?:(?<!{inside})(?<!ORD-)|(?!{inside}))"), quoted, F.lit(rf"(?:(?!{inside})|(?<!{inside}))")
    )


def holds_token(text: Column, value: Column) -> Column:
    """Whether ``value`` stands in ``text`` as a token of its own; false if it is missing or empty."""
    return F.coalesce((value != "") & F.contains(text, value) & F.regexp_like(text, _as_token(value)), F.lit(False))


def redact_known_values(text: Column, known: tuple[tuple[str, str], ...] = KNOWN_VALUE_LABELS) -> Column:
    """Replace values that stand in other columns of the row, each as a token of its own.

    Only a row whose text contains the value pays for its pattern. A missing or
    empty value changes nothing.
    """

    def without(text: Column, value: Column, label: str) -> Column:
        def body(t: Column) -> Column:
            found = (value != "") & F.contains(t, value)
            return F.when(found, F.regexp_replace(t, _as_token(value), F.lit(label))).otherwise(t)

        return _once(text, body)

    return reduce(lambda current, known_value: without(current, F.col(known_value[0]), known_value[1]), known, text)


def _birth_date_forms(birth_date: Column) -> Column:
    """Pattern for a date in its common numeric forms, standing alone."""
    year, month, day = (part(birth_date).cast("string") for part in (F.year, F.month, F.dayofmonth))
    m, d = F.concat(F.lit("0?"), month), F.concat(F.lit("0?"), day)
    forms = [F.concat_ws("[/.-]", *parts) for parts in ((year, m, d), (d, m, year), (m, d, year))]
    return F.concat(F.lit(r"(?<![0-9A-Za-z_])(?:"), F.concat_ws("|", *forms), F.lit(r")(?![0-9A-Za-z_])"))


def _has_year(text: Column, birth_date: Column) -> Column:
    return F.contains(text, F.year(birth_date).cast("string"))


def holds_birth_date(text: Column, birth_date: Column) -> Column:
    """Whether the date stands in ``text`` in one of its common numeric forms; false if it is missing."""
    found = _has_year(text, birth_date) & F.regexp_like(text, _birth_date_forms(birth_date))
    return F.coalesce(found, F.lit(False))


def redact_known_birth_date(text: Column, birth_date: Column) -> Column:
    """Replace the row's birth date in its common forms. Only a text with its year pays for the pattern.

    A date of another kind that is equal to it, such as an order date, goes as well: the text does not tell which is meant.
    """

    def body(t: Column) -> Column:
        return F.when(_has_year(t, birth_date), F.regexp_replace(t, _birth_date_forms(birth_date), F.lit("[DOB]"))).otherwise(t)

    return _once(text, body)


def labels_in(text: Column) -> Column:
    """All labels that stand in ``text``, in order, as an array; one search for all of them."""
    names = "|".join(label[1:-1] for label in LABELS)
    return F.regexp_extract_all(text, F.lit(rf"\[(?:{names})\]"), F.lit(0))


def luhn_valid(number: Column) -> Column:
    """Whether the digits of a number pass the checksum of payment cards: every second one from the right doubled."""
    digits = F.regexp_replace(number, "[^0-9]", "")

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.when(digits == "", F.lit(False)).otherwise(F.aggregate(places, F.lit(0), add) % 10 == 0)


def iban_valid(account: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, with its first four signs moved behind and letters as 10 to 35."""
    signs = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substring(signs, F.lit(5), F.length(signs)), F.left(signs, F.lit(4)))

    def step(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def replace_valid(text: Column, pattern: str, is_valid: Callable[[Column], Column], label: str) -> Column:
    """Replace the hits of ``pattern`` that are valid; the others stay where they are."""

    def put_together(t: Column) -> Column:
        hits = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        between = F.split(t, pattern, -1)
        kept = F.zip_with(
            between, hits, lambda b, h: F.concat(b, F.when(h.isNull(), "").when(is_valid(h), F.lit(label)).otherwise(h))
        )
        return F.array_join(kept, "")

    return _once(text, lambda t: F.when(t.rlike(pattern), put_together(t)).otherwise(t))


def redact_valid_cards(text: Column) -> Column:
    """Cards and bank accounts whose checksums are right; order and invoice numbers of as many digits stay."""
    checks = {"bank_account": iban_valid, "card_number": luhn_valid}
    return reduce(
        lambda current, rule: replace_valid(current, rule.pattern, checks[rule.name], rule.label), [r for r in RULES if r.name in checks], text
    )
