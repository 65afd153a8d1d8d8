"""DuckDB SQL that says independently what each registered query must return."""

from anonkit.oracle import columns, questions, tables, texts


def oracle_sql() -> dict[str, str]:
    return {**tables.SQL, **columns.SQL, **questions.SQL, **texts.SQL}
