"""Inputs and outputs: staging relations, seed crosswalks, table sinks."""
