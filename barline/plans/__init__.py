"""Composed jobs: staging to mart models, strategies and backtests."""
