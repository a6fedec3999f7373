"""The registered queries: the given tables seen as posts, users and ledgers, each query with its SQL twin."""
