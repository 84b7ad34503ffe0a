"""versus: pairwise judging of candidate texts against a reference text, on Spark."""
