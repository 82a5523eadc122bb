"""File reads under explicit schemas, and staging into typed tables."""
