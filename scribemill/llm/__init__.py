"""Operations of a large-scale training-data pipeline, kept apart from the rest of the library."""
