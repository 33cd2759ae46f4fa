"""The layer jobs: silver, gold, marts, and the whole warehouse."""
