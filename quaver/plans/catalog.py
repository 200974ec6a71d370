"""Registered queries of the engine and the SQL that must give the same rows."""

from __future__ import annotations

from quaver.plans import archive, corpus, music

TABLES = (music.TABLE, corpus.TABLE, archive.TABLE)


def queries():
    return {name: run for part in TABLES for name, (run, _) in part.items()}


def oracle_sql():
    return {name: sql for part in TABLES for name, (_, sql) in part.items() if sql}
