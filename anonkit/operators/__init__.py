"""DataFrame operators: anonymization, audits, k-anonymity, redaction, keyed updates, profiles."""
