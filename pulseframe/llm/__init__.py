"""Operations of a training-data pipeline: filters, scans, copies, tokens, conversations and archives."""
