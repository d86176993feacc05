"""DataFrame operators: cleaning, contract, profiles, ranking, statistics, measures."""
