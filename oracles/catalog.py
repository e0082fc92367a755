"""All statements by query name."""

from oracles import exploration, features, fleet_queries, quality, scoring

STATEMENTS: dict[str, str] = {
    **quality.SQL, **fleet_queries.SQL, **features.SQL, **exploration.SQL, **scoring.SQL,
}
