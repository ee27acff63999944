"""DataFrame -> DataFrame operators: courses, relational, demand, affinity,
profiles, distributed order statistics, metrics and drift."""
