"""Registered queries over the test tables and their SQL twins."""

from firmlake.workload import files, interfaces, lists, records, reports, values

PARTS = (interfaces, records, values, lists, reports, files)
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in PARTS for name, sql in part.ORACLE.items()}
