"""Whole analyses: topics, word vectors, models, stored versions, jobs."""
