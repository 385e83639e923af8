"""Every operator as a query on the given tables, with the SQL that must give the same rows."""

from queries import logs, lookups, streams, values

QUERIES = {**lookups.QUERIES, **values.QUERIES, **logs.QUERIES, **streams.QUERIES}
ORACLES = {**lookups.ORACLES, **values.ORACLES, **logs.ORACLES, **streams.ORACLES}
