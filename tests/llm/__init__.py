"""Tests of the text-pipeline operators."""
