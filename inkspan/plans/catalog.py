"""All queries of the reference's operators, and the SQL that checks them."""

from __future__ import annotations

from inkspan.plans import pairs, records, texts

QUERIES = {**texts.QUERIES, **records.QUERIES, **pairs.QUERIES}
SQL = {**texts.SQL, **records.SQL, **pairs.SQL}
