"""Every operator run over the test tables, next to the SQL it must agree with."""

from aerolake.queries import jobs, modelling, monitoring, preparation, scans

CATALOG = {**scans.QUERIES, **preparation.QUERIES, **monitoring.QUERIES, **modelling.QUERIES,
           **jobs.QUERIES}
