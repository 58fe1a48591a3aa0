"""DataFrame -> DataFrame operators: statistics, joins, rankings, keyed cells, display columns."""
