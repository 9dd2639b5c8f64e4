"""Streaming: domain-pair counts kept up to date as link files arrive."""
