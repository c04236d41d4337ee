"""DataFrame operators of every layer (silver, gold, clutch, rankings,
pages, quality)."""
