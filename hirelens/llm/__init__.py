"""Operations for large training corpora: joins of similar texts, classifiers, search, scans, mixing, tokenising."""
