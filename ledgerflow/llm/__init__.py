"""Operations of a training-data pipeline: cleaning, deduplication, packing and search."""
