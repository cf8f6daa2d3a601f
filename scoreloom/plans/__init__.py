"""Compositions: staging, marts, serving extracts, rating model, bracket, team profiles."""
