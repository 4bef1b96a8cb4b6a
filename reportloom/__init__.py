"""DataFrame operators for preparing, redacting, retrieving and scoring report texts."""
