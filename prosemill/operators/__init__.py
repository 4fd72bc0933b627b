"""DataFrame-to-DataFrame operators over corpora, votes, audits, censuses and rankings."""
