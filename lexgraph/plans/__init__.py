"""Physical-plan helpers (staging, size-checked joins) and the job chains built from the operators."""
