"""SQL twin of the two stemmers: regular expressions over the distinct words, step by step."""

from __future__ import annotations

from crawlflow.functions.stem import (
    ENGLISH_2, ENGLISH_3, ENGLISH_4, ENGLISH_KEPT, ENGLISH_SPECIAL, PORTER_2, PORTER_3, PORTER_4,
)

V, C = "[aeiouy]", "[^aeiouy]"


def ending(word: str, endings) -> str:
    return f"regexp_extract({word}, '({'|'.join(e.replace(chr(39), chr(39) * 2) for e in endings)})$', 1)"


def has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


def measure(text: str) -> str:
    return f"len(regexp_extract_all({text}, '{V}{C}'))"


def mapped(value: str, table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {value} {cases} END"


def steps() -> list[dict[str, str]]:
    """Each entry adds columns to the one before; ``w`` is the word, ``stem`` the result."""
    made: list[dict[str, str]] = []
    word = "w"

    def add(**columns: str) -> None:
        made.append(columns)

    def change(name: str, endings, sql: str) -> str:
        """A step on the word's longest ending ``e``, with ``s`` in front of it."""
        nonlocal word
        add(**{f"{name}_e": ending(word, endings)})
        add(**{f"{name}_s": f"left({word}, length({word}) - length({name}_e))"})
        add(**{name: sql.replace("{e}", f"{name}_e").replace("{s}", f"{name}_s").replace("{w}", word)})
        word = name
        return name

    # Porter. A y that is a consonant is written Y, so that the letter classes are plain.
    add(m=f"""list_reduce(string_split(w, ''), lambda acc, c: acc ||
        CASE WHEN c = 'y' AND (acc = '' OR regexp_matches(acc, '{V}$')) THEN 'Y' ELSE c END, '')""")
    word = "m"
    change("p1", ("sses", "ies", "ss", "s"), "CASE {e} WHEN 'sses' THEN {s} || 'ss' WHEN 'ies' THEN {s} || 'i' WHEN 's' THEN {s} ELSE {w} END")
    change("p2", ("eed", "ed", "ing"), f"""CASE WHEN {{e}} = '' THEN {{w}}
        WHEN {{e}} = 'eed' THEN CASE WHEN {measure('{s}')} > 0 THEN {{s}} || 'ee' ELSE {{w}} END
        WHEN NOT {has('{s}', V)} THEN {{w}}
        WHEN {has('{s}', '(at|bl|iz)$')} THEN {{s}} || 'e'
        WHEN length({{s}}) > 1 AND lower(right({{s}}, 1)) = lower(left(right({{s}}, 2), 1)) AND {has('{s}', C + '$')}
            THEN CASE WHEN {has('{s}', '[lsz]$')} THEN {{s}} ELSE left({{s}}, length({{s}}) - 1) END
        WHEN {measure('{s}')} = 1 AND {has('{s}', f'{C}{V}[^aeiouywxY]$')} THEN {{s}} || 'e' ELSE {{s}} END""")
    change("p3", ("y", "Y"), f"CASE WHEN {{e}} <> '' AND {has('{s}', V)} THEN {{s}} || 'i' ELSE {{w}} END")
    for name, table in (("p4", PORTER_2), ("p5", PORTER_3)):
        change(name, table, f"CASE WHEN {{e}} <> '' AND {measure('{s}')} > 0 THEN {{s}} || {mapped('{e}', table)} ELSE {{w}} END")
    change("p6", PORTER_4, f"CASE WHEN {{e}} <> '' AND {measure('{s}')} > 1 AND ({{e}} <> 'ion' OR {has('{s}', '[st]$')}) THEN {{s}} ELSE {{w}} END")
    change("p7", ("e",), f"CASE WHEN {{e}} <> '' AND ({measure('{w}')} > 1 OR ({measure('{w}')} = 1 AND NOT {has('{s}', f'{C}{V}[^aeiouywxY]$')})) THEN {{s}} ELSE {{w}} END")
    change("p8", ("ll",), f"CASE WHEN {{e}} <> '' AND {measure('{w}')} > 1 THEN {{s}} || 'l' ELSE {{w}} END")
    add(p="CASE WHEN length(w) <= 2 THEN w ELSE lower(p8) END")

    # English.
    add(q=f"regexp_replace(regexp_replace(p, '^''', ''), '(^|{V})y', '\\1Y', 'g')")
    pair = f"^.*?{V}{C}"
    first = f"regexp_extract(q, '{pair}')"
    add(r1=f"CASE WHEN {has('q', '^(gener|commun|arsen)')} THEN length(regexp_extract(q, '^(gener|commun|arsen)')) WHEN {first} = '' THEN length(q) ELSE length({first}) END")
    second = f"regexp_extract(substr(q, r1 + 1), '{pair}')"
    add(r2=f"CASE WHEN {second} = '' THEN length(q) ELSE r1 + length({second}) END")
    word = "q"
    short = f"({C}{V}[^aeiouywxY]|^{V}{C})$"
    change("e0", ("'s'", "'s", "'"), "{s}")
    change("e1", ("sses", "ied", "ies", "us", "ss", "s"), f"""CASE WHEN {{e}} = 'sses' THEN {{s}} || 'ss'
        WHEN {{e}} IN ('ied', 'ies') THEN {{s}} || CASE WHEN length({{s}}) > 1 THEN 'i' ELSE 'ie' END
        WHEN {{e}} = 's' AND {has('left({w}, greatest(length({w}) - 2, 0))', V)} THEN {{s}} ELSE {{w}} END""")
    kept = "e1"
    change("e2", ("eedly", "eed", "edly", "ed", "ingly", "ing"), f"""CASE WHEN {{e}} = '' THEN {{w}}
        WHEN {{e}} IN ('eed', 'eedly') THEN CASE WHEN length({{s}}) >= r1 THEN {{s}} || 'ee' ELSE {{w}} END
        WHEN NOT {has('{s}', V)} THEN {{w}}
        WHEN {has('{s}', '(at|bl|iz)$')} THEN {{s}} || 'e'
        WHEN {has('{s}', '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$')} THEN left({{s}}, length({{s}}) - 1)
        WHEN r1 >= length({{s}}) AND {has('{s}', short)} THEN {{s}} || 'e' ELSE {{s}} END""")
    change("e3", ("y", "Y"), f"CASE WHEN {{e}} <> '' AND {has('{s}', f'.{C}$')} THEN {{s}} || 'i' ELSE {{w}} END")
    change("e4", ENGLISH_2, f"""CASE WHEN {{e}} = '' OR length({{s}}) < r1 THEN {{w}}
        WHEN {{e}} = 'li' THEN CASE WHEN {has('{s}', '[cdeghkmnrt]$')} THEN {{s}} ELSE {{w}} END
        WHEN {{e}} = 'ogi' AND NOT {has('{s}', 'l$')} THEN {{w}} ELSE {{s}} || {mapped('{e}', ENGLISH_2)} END""")
    change("e5", ENGLISH_3, f"CASE WHEN {{e}} <> '' AND length({{s}}) >= CASE WHEN {{e}} = 'ative' THEN r2 ELSE r1 END THEN {{s}} || {mapped('{e}', ENGLISH_3)} ELSE {{w}} END")
    change("e6", ENGLISH_4, f"CASE WHEN {{e}} <> '' AND length({{s}}) >= r2 AND ({{e}} <> 'ion' OR {has('{s}', '[st]$')}) THEN {{s}} ELSE {{w}} END")
    change("e7", ("e", "ll"), f"""CASE WHEN {{e}} = 'e' AND (length({{s}}) >= r2 OR (length({{s}}) >= r1 AND NOT {has('{s}', short)})) THEN {{s}}
        WHEN {{e}} = 'll' AND length({{s}}) + 1 >= r2 THEN {{s}} || 'l' ELSE {{w}} END""")
    special = mapped("p", ENGLISH_SPECIAL)
    kept_words = ", ".join(f"'{k}'" for k in ENGLISH_KEPT)
    add(stem=f"CASE WHEN length(p) <= 2 THEN p WHEN {special} IS NOT NULL THEN {special} WHEN {kept} IN ({kept_words}) THEN {kept} ELSE replace(e7, 'Y', 'y') END")
    return made


def stem_ctes(words: str) -> str:
    """CTEs ending in ``stems(w, stem)`` for the column ``token`` of the CTE ``words``."""
    parts = [f"step_0 AS (SELECT DISTINCT token AS w FROM {words})"]
    for i, columns in enumerate(steps(), 1):
        added = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
        parts.append(f"step_{i} AS (SELECT *, {added} FROM step_{i - 1})")
    return ",\n".join(parts) + f",\nstems AS MATERIALIZED (SELECT w, stem FROM step_{len(parts) - 1})"
