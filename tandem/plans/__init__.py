"""Physical-plan helpers: size checks, staged tables and skew-safe joins."""
