"""The models and jobs a user calls."""
