"""Oracle statements for free-text redaction, with the rules in RE2 syntax."""

from __future__ import annotations

from anonkit.oracle.base import ANON, ORDERS, moment, number, on_orders

_CAPITAL = r"\p{Lu}[\p{L}'-]*"
# Months, words that make a date a birth date, names of a birth date, and what stands before such a name.
_MONTHS = (
    "January|February|March|April|May|June|July|August|September|October|November|December"
    "|Januar|Februar|März|Mai|Juni|Juli|Oktober|Dezember"
    "|janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre"
    "|enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre"
    "|januari|februari|maart|april|mei|juni|juli|augustus|september|oktober|november|december"
)
_BIRTH = (
    "born|birth|birthday|birthdate|date of birth|dob|geboren|geb[.]|geburtsdatum|née|né|naissance|nacida|nacido|nacimiento|geboortedatum"
)
_BIRTH_NAMES = "date of birth|birthday|birthdate|dob|geburtsdatum|geburtstag|date de naissance|fecha de nacimiento|geboortedatum"
_COPULAS = "is|was|ist|war|est|était|es|era"
_OWNERS = "my|his|her|their|the|customer's|mein|sein|ihr|das|ma|sa|la|mi|su|mijn|de"
_YEAR = "(?:19|20)[0-9]{2}"
_DATE = (
    rf"(?:{_YEAR}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}[/.-][0-9]{{1,2}}[/.-]{_YEAR}"
    rf"|[0-9]{{1,2}}(?:st|nd|rd|th|er|[.])? (?:de )?(?:{_MONTHS})(?: de)? {_YEAR}|(?:{_MONTHS}) [0-9]{{1,2}}(?:st|nd|rd|th)?,? {_YEAR})"
)
# A sentence goes on over a point that no white space follows; \x01 stands for a label that is there already.
_ENDS = r".;!?\n\x01"
_ON = rf"(?:[^{_ENDS}]|[.]+[^\s{_ENDS}])"
_FIRST = rf"(?:[^\p{{L}}0-9_{_ENDS}]|[.]+[^\s{_ENDS}])"
_FORWARD = rf"((?:^|[^0-9A-Za-z_\[])(?i:{_BIRTH})(?:{_FIRST}{_ON}*?)?[.]*)\b{_DATE}\b"
_BACKWARD = (
    rf"\b{_DATE}\b((?: (?:{_COPULAS}))?[,(:-]? ?[(]?(?:(?i:{_OWNERS}) ){{0,2}}(?i:{_BIRTH_NAMES})"
    r"(?: of [\p{L}' -]{1,60})?(?:[).,;:!?\n]|$))"
)

# Label, pattern and replacement of each rule, in order.
RULES = [
    ("card", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b", "[CARD]"),
    (
        "card",
        r"\b(?:[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})\b",
        "[CARD]",
    ),
    ("email", r"[\p{Latin}0-9._%+-]+@[\p{Latin}0-9.-]+[.]\p{Latin}{2,}", "[EMAIL]"),
    ("ip", r"\b[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}\b", "[IP]"),
    ("dob", r"\[DOB\]", "\x01"),
    ("dob", _FORWARD, r"\1[DOB]"),
    ("dob", r"\x01", "[DOB]"),
    ("dob", rf"(\[DOB\] (?:or|oder|ou|o|of|/) ){_DATE}\b", r"\1[DOB]"),
    ("dob", _BACKWARD, r"[DOB]\1"),
    ("phone", r"[+][0-9]{1,3}[ .-]?[(]?[0-9]{1,4}[)]?(?:[ .-]?[0-9]{2,4}){2,4}", "[PHONE]"),
    ("phone", r"[(]0[0-9]{1,4}[)][ -]{0,2}[0-9]{4,8}\b", "[PHONE]"),
    ("phone", r"\b[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}\b", "[PHONE]"),
    (
        "address",
        rf"\b[0-9]+[A-Za-z]? {_CAPITAL} (?:{_CAPITAL} )*?(?:Street|Road|Avenue|Lane|Square)\b(?:, {_CAPITAL})?",
        "[ADDRESS]",
    ),
    (
        "address",
        rf"(^|[^\p{{L}}0-9_])(?:Calle|Avenida|Plaza|Paseo|Camino) (?:(?:de|del|la|las|los|el) )*{_CAPITAL}"
        rf"(?: (?:(?:de|del|la|las|los|el) )*{_CAPITAL})*,? [0-9]+[A-Za-z]?\b",
        r"\1[ADDRESS]",
    ),
    (
        "address",
        r"(^|[^\p{L}0-9_])\p{Lu}\p{L}*(?:straße|strasse|weg|platz|allee|gasse|straat|laan|plein|gracht|kade) [0-9]+[A-Za-z]?\b",
        r"\1[ADDRESS]",
    ),
    (
        "address",
        r"\b[0-9]+(?: bis| ter)?,? (?:rue|avenue|boulevard|place|chemin|allée|impasse|quai) (?:(?:de|du|des|la|le|les) )*(?:[dl]')?"
        rf"{_CAPITAL}(?: {_CAPITAL})*",
        "[ADDRESS]",
    ),
    (
        "name",
        rf"\b([Mm]y name is ){_CAPITAL}(?: (?:(?:de|del|della|da|dos|das|di|du|la|las|le|los|van|von|der|den|ten|ter|zu|y|e|bin|ibn) )*"
        rf"{_CAPITAL})*",
        r"\1[NAME]",
    ),
    ("id", r"CUST-[0-9]{6,}", "[ID]"),
    ("id", r"\b([Pp]assport(?: number| no[.]?)?:? )[A-Z]{0,2}[0-9]{6,}\b", r"\1[ID]"),
    (
        "id",
        r"\b(?:(?:[0-9]{8}|[XYZ][0-9]{7})-?[A-Z]|[0-9]{7}[A-W][A-IW]?"
        r"|[A-Z]{2} ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[A-D]|[0-9]{3}-[0-9]{2}-[0-9]{4})\b",
        "[ID]",
    ),
]
LABELS = ["NAME", "EMAIL", "PHONE", "ADDRESS", "DOB", "ID", "CARD", "IP"]
KNOWN = [("email", "EMAIL"), ("street_address", "ADDRESS"), ("full_name", "NAME"), ("phone", "PHONE")]


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def by_rules(expr: str, kind: str | None = None) -> str:
    for name, pattern, replacement in RULES:
        if kind in (None, name):
            expr = f"regexp_replace({expr}, {_literal(pattern)}, {_literal(replacement)}, 'g')"
    return expr


_SIGN = "0-9A-Za-z_À-ÿ"  # of a token; a short class, as DuckDB compiles these patterns for each row


def _token(column: str) -> str:
    """Pattern for a known value that stands alone: no letter, digit or underscore next to one of its own at either end."""
    return (
        f"(CASE WHEN regexp_matches({column}, '^[{_SIGN}]') THEN '(^|[^{_SIGN}])' ELSE '()' END"
        f" || regexp_escape({column}) || CASE WHEN regexp_matches({column}, '[{_SIGN}]$') THEN '($|[^{_SIGN}])' ELSE '()' END)"
    )


def _without_known(text: str, column: str, label: str) -> str:
    """Twice, as neighbours share the sign between them; an order id is kept whole by an underscore in it."""
    once = f"regexp_replace(replace({text}, 'ORD-', 'ORD_'), {_token(column)}, '\\1[{label}]\\2', 'g')"
    twice = f"regexp_replace({once}, {_token(column)}, '\\1[{label}]\\2', 'g')"
    return f"CASE WHEN contains({text}, {column}) THEN replace({twice}, 'ORD_', 'ORD-') ELSE {text} END"


def _holds(text: str, column: str) -> str:
    return f"({column} <> '' AND contains({text}, {column}) AND regexp_matches(replace({text}, 'ORD-', 'ORD_'), {_token(column)}))"


# one step per known value: nested CASE expressions would double the statement each time
_KNOWN_STEPS = ["known0 AS (SELECT *, customer_notes AS t FROM orders_flat WHERE customer_notes <> '')"]
for _i, (_column, _label) in enumerate(KNOWN):
    _KNOWN_STEPS.append(
        f"""known{_i + 1} AS (SELECT * REPLACE (
    CASE WHEN coalesce({_column}, '') <> '' THEN {_without_known("t", _column, _label)} ELSE t END AS t)
  FROM known{_i})"""
    )
_FORMS = (
    "'\\b(?:' || concat_ws('|', y || '[/.-]0?' || m || '[/.-]0?' || d, '0?' || d || '[/.-]0?' || m || '[/.-]' || y,"
    " '0?' || m || '[/.-]0?' || d || '[/.-]' || y) || ')\\b'"
)
_KNOWN_STEPS.append(
    f"""dated AS (SELECT * EXCLUDE (y, m, d), CASE WHEN y IS NOT NULL THEN {_FORMS} END AS birth_forms
  FROM (SELECT *, year(birth_date) AS y, month(birth_date) AS m, day(birth_date) AS d FROM known{len(KNOWN)}))"""
)
_KNOWN_STEPS.append(
    "knownd AS (SELECT * REPLACE (CASE WHEN birth_forms IS NOT NULL THEN regexp_replace(t, birth_forms, '[DOB]', 'g') ELSE t END AS t)"
    " FROM dated)"
)
_KNOWN_STEPS.append(f"redacted AS (SELECT *, {by_rules('t')} AS note_redacted FROM knownd)")
KNOWN_STEPS = tuple(_KNOWN_STEPS)

TEXTS = """texts AS (
  SELECT 'document' AS kind, doc_id::VARCHAR AS text_id, lang, text FROM documents
  UNION ALL SELECT 'conversation', conv_id::VARCHAR || '/' || turn::VARCHAR, 'unknown', text FROM conversations
  UNION ALL SELECT 'note', order_id, 'en', customer_notes FROM orders_flat WHERE customer_notes <> '')"""


def on_texts(body: str) -> str:
    return on_orders(body, TEXTS)


def _hits(label: str) -> str:
    width = len(label) + 2
    count = f"(length({{0}}) - length(replace({{0}}, '[{label}]', ''))) // {width}"
    return f"({count.format('r')} - {count.format('text')})"


_AUDIT = "\nUNION ALL\n".join(
    f"""SELECT '[{label}]' AS label, '{column}' AS source_column,
  count(*) FILTER ({_holds("customer_notes", column)}) AS notes_with_value,
  count(*) FILTER ({_holds("by_rules", column)}) AS visible_after_rules,
  count(*) FILTER ({_holds("note_redacted", column)}) AS visible_after_redaction
FROM (SELECT *, {by_rules("customer_notes")} AS by_rules FROM redacted)"""
    for column, label in KNOWN
)
_AUDIT += f"""\nUNION ALL\nSELECT '[DOB]', 'birth_date', count(*) FILTER (regexp_matches(customer_notes, birth_forms)),
  count(*) FILTER (regexp_matches(by_rules, birth_forms)), count(*) FILTER (regexp_matches(note_redacted, birth_forms))
FROM (SELECT *, {by_rules("customer_notes")} AS by_rules FROM redacted)"""
_FORM = "substr(order_id, 5)::BIGINT % 16"
# How many values of each label the note forms hold.
_TRUTH = {
    "NAME": f"CASE WHEN {_FORM} IN (0, 2) THEN 1 WHEN {_FORM} = 13 THEN 2 ELSE 0 END",
    "EMAIL": f"CASE WHEN {_FORM} = 13 OR {_FORM} = 0 AND email IS NOT NULL THEN 1 ELSE 0 END",
    "PHONE": f"CASE WHEN {_FORM} = 0 AND phone IS NOT NULL THEN 1 ELSE 0 END",
    "ADDRESS": f"CASE {_FORM} WHEN 0 THEN 1 WHEN 10 THEN 2 ELSE 0 END",
    "DOB": f"CASE WHEN {_FORM} IN (2, 14) AND birth_date IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN {_FORM} = 14 THEN 1 ELSE 0 END",
    "ID": f"CASE WHEN {_FORM} IN (2, 6) THEN 1 ELSE 0 END",
    "CARD": f"CASE WHEN {_FORM} = 6 THEN 1 ELSE 0 END",
    "IP": f"CASE WHEN {_FORM} = 6 THEN 1 ELSE 0 END",
}
_PRECISION = "\nUNION ALL\n".join(
    f"""SELECT '[{label}]' AS label, sum(e)::BIGINT AS expected, sum(least(e, f))::BIGINT AS right_labels,
  sum(greatest(e - f, 0))::BIGINT AS missed, sum(greatest(f - e, 0))::BIGINT AS false_labels
FROM (SELECT {truth} AS e, (length(note_redacted) - length(replace(note_redacted, '[{label}]', ''))) // {len(label) + 2} AS f
  FROM redacted)"""
    for label, truth in _TRUTH.items()
)
_EXPORT = f"""SELECT a.* EXCLUDE (customer_notes) REPLACE ({number("order_value_random")} AS order_value_random,
  {moment("a.order_date")} AS order_date), note_redacted AS customer_notes_anonymized
FROM anon a LEFT JOIN redacted r USING (order_id)"""

# All values of all customers, each looked for in all texts.
_W = r"[\p{L}\p{N}_]"
_S = r"[^\p{L}\p{N}_]"
VALUES = f"""vals AS (
  SELECT core, min(label) AS label, arg_min(lead, label) AS lead, any_value(words) AS words FROM (
    SELECT label, regexp_extract(value, '^({_S}*)', 1) AS lead, regexp_replace(value, '^{_S}+|{_S}+$', '', 'g') AS core,
      len(regexp_extract_all(core, '{_W}+')) AS words
    FROM (SELECT DISTINCT '1[EMAIL]' AS label, email AS value FROM orders_flat
      UNION ALL SELECT DISTINCT '2[ADDRESS]', street_address FROM orders_flat
      UNION ALL SELECT DISTINCT '3[NAME]', full_name FROM orders_flat
      UNION ALL SELECT DISTINCT '4[PHONE]', phone FROM orders_flat)
    WHERE value IS NOT NULL)
  WHERE words > 1 OR length(core) >= 7 GROUP BY core)"""
_HELD = f"""held AS (
  SELECT kind, text_id, label, string_agg('(?:' || regexp_escape(lead) || ')?' || regexp_escape(core), '|' ORDER BY length(core) DESC) AS p
  FROM texts JOIN vals ON contains(text, core) GROUP BY ALL),
patterns AS (
  SELECT kind, text_id, map(list(label), list('(^|{_S})(?:' || p || ')($|{_S})')) AS p FROM held GROUP BY ALL)"""


def _all_values_replaced() -> tuple[str, ...]:
    steps = ["all0 AS (SELECT t.kind, t.text_id, text AS t, p FROM texts t LEFT JOIN patterns USING (kind, text_id))"]
    for i, label in enumerate(("1[EMAIL]", "2[ADDRESS]", "3[NAME]", "4[PHONE]")):
        once = f"regexp_replace(t, p['{label}'], '\\1{label[1:]}\\2', 'g')"
        twice = f"regexp_replace({once}, p['{label}'], '\\1{label[1:]}\\2', 'g')"  # neighbours share a sign
        steps.append(f"all{i + 1} AS (SELECT * REPLACE (CASE WHEN p['{label}'] IS NOT NULL THEN {twice} ELSE t END AS t) FROM all{i})")
    return tuple(steps)


_MISSPELT = f"""cuts AS (SELECT kind, text_id, regexp_extract_all(text, '{_W}+|{_S}+') AS q FROM texts),
two AS (
  SELECT kind, text_id, unnest(range(1, len(q) - 1)) AS place, q[place] || q[place + 1] || q[place + 2] AS found,
    regexp_matches(q[place], '^{_W}') AS starts FROM cuts),
names AS (SELECT DISTINCT full_name AS core FROM orders_flat)"""

def _checked(t: str, pattern: str, valid: str) -> str:
    """Hits that are valid replaced; the texts between hits and the hits themselves, one after the other."""
    hits, between = f"regexp_extract_all({t}, {_literal(pattern)})", f"regexp_split_to_array({t}, {_literal(pattern)})"
    return (
        f"array_to_string(list_transform(list_zip({between}, {hits}), lambda z: coalesce(z[1], '') || CASE WHEN z[2] IS NULL THEN ''"
        f" WHEN {valid} THEN '[CARD]' ELSE z[2] END), '')"
    )


_LUHN = (
    "list_sum(list_transform(range(1, length(regexp_replace(z[2], '[^0-9]', '', 'g')) + 1), lambda i: CASE WHEN i % 2 = 1 THEN"
    " reverse(regexp_replace(z[2], '[^0-9]', '', 'g'))[i]::BIGINT ELSE"
    " (2 * reverse(regexp_replace(z[2], '[^0-9]', '', 'g'))[i]::BIGINT) // 10 + (2 * reverse(regexp_replace(z[2], '[^0-9]', '', 'g'))[i]::BIGINT) % 10 END)) % 10 = 0"
)
_SIGNS = "replace(z[2], ' ', '')"
_MOD97 = (  # the whole number, as text, of at most 34 signs: taken in parts of one sign
    f"list_reduce(list_concat([0::BIGINT], list_transform(string_split(substr({_SIGNS}, 5) || left({_SIGNS}, 4), ''), lambda c:"
    " CASE WHEN c BETWEEN '0' AND '9' THEN c::BIGINT ELSE ascii(c) - 55 END)),"
    " lambda a, d: (CASE WHEN d < 10 THEN a * 10 ELSE a * 100 END + d) % 97) = 1"
)

SQL = {
    "redact_card_checked": on_texts(
        f"""SELECT kind, text_id, {_checked("t", RULES[1][1], _LUHN)} AS redacted
FROM (SELECT kind, text_id, {_checked("text", RULES[0][1], _MOD97)} AS t FROM texts)"""
    ),
    "redact_all_values": on_orders(
        "SELECT kind, text_id, t AS redacted FROM all4", TEXTS, VALUES, _HELD, *_all_values_replaced()
    ),
    "find_misspelt_names": on_orders(
        """SELECT kind, text_id, place, found, min(levenshtein(found, core))::BIGINT AS distance, count(*) AS names_near
FROM two JOIN names ON starts AND levenshtein(found, core) <= 1 AND len(regexp_extract_all(core, '[\\p{L}\\p{N}_]+')) = 2
GROUP BY ALL""",
        TEXTS,
        _MISSPELT,
    ),
    **{
        f"redact_{kind}": on_texts(f"SELECT kind, text_id, {by_rules('text', kind)} AS redacted FROM texts")
        for kind in ("email", "phone", "card", "id", "dob", "address", "name")
    },
    "redact_documents": on_texts(f"SELECT kind, text_id, {by_rules('text')} AS redacted FROM texts"),
    "redact_unchanged": on_texts(
        f"""SELECT kind, count(*) AS texts, count(*) FILTER ({by_rules('text')} = text) AS unchanged
FROM texts GROUP BY kind"""
    ),
    "label_counts": on_texts(
        "\nUNION ALL\n".join(
            f"""SELECT kind, lang, '[{label}]' AS label, sum({_hits(label)})::BIGINT AS hits,
  count(*) FILTER ({_hits(label)} > 0) AS texts
FROM (SELECT *, {by_rules('text')} AS r FROM texts) GROUP BY kind, lang"""
            for label in LABELS
        )
    ),
    "redact_known_values": on_orders(
        f"SELECT order_id, t AS note_redacted FROM known{len(KNOWN)}", *KNOWN_STEPS
    ),
    "redact_notes": on_orders(
        """SELECT o.order_id, note_redacted AS customer_notes_anonymized
FROM orders_flat o LEFT JOIN redacted r USING (order_id)""",
        *KNOWN_STEPS,
    ),
    "audit_redaction": on_orders(_AUDIT, *KNOWN_STEPS),
    "audit_redaction_precision": on_orders(_PRECISION, *KNOWN_STEPS),
    "export_orders": "WITH " + ",\n".join([ORDERS, ANON, *KNOWN_STEPS]) + "\n" + _EXPORT,
    "stream_anonymize": "WITH " + ",\n".join([ORDERS, ANON, *KNOWN_STEPS]) + "\n" + _EXPORT,
    "inc_checkpoint_update": on_orders(
        """SELECT o.order_id, note_redacted AS customer_notes_anonymized
FROM orders_flat o LEFT JOIN redacted r USING (order_id)""",
        *KNOWN_STEPS,
    ),
    "upd_by_key_partitions": on_orders(
        """SELECT o.order_id, o.customer_segment, strftime(o.order_date, '%Y-%m') AS order_month,
  CASE WHEN o.order_date < DATE '1994-01-01' THEN coalesce(note_redacted, o.customer_notes) ELSE o.customer_notes END AS customer_notes
FROM orders_flat o LEFT JOIN redacted r USING (order_id)""",
        *KNOWN_STEPS,
    ),
    "inc_checkpoint": on_orders(
        "SELECT order_id, note_redacted AS customer_notes_anonymized FROM redacted", *KNOWN_STEPS
    ),
    "upd_by_key": on_orders(
        """SELECT o.order_id, o.customer_segment, coalesce(note_redacted, o.customer_notes) AS customer_notes
FROM orders_flat o LEFT JOIN redacted r USING (order_id)""",
        *KNOWN_STEPS,
    ),
}
