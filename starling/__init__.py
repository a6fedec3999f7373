"""Social-post analytics as DataFrame plans: cleaning, contact graph, topics and ledger audits."""
