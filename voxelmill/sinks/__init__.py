"""Writers of chunked arrays, headers, projections and metadata."""
