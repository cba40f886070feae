"""DataFrame-to-DataFrame operators: digests, comparisons, changes, audits."""
