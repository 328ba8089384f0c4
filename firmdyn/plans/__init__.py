"""Plans: the full outcome run (``outcomes``), the registered queries (``queries``) and
the naive reference-shaped SQL used as oracle and as the naive benchmark plan
(``naive_sql``)."""
